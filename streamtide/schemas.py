"""All declared schemas. No reader in this package infers a schema."""

# one poll of one stream, as landed in delimited text
STREAM_SAMPLE = (
    "channel_id long, viewers long, game string, name string, status string, "
    "created string, mature boolean, updated_at string, fps double"
)

# one page of the stream listing, its elements still text; an element is parsed
# by itself, so a malformed one spoils neither its page nor its neighbours
STREAM_PAGE = "streams array<string>, _corrupt_record string"
STREAM_ELEMENT = (
    "_id string, viewers string, average_fps string, "
    "channel struct<game: string, name: string, status: string, "
    "mature: string, updated_at: string>, _corrupt_record string"
)

CHAT_MESSAGE = "ts timestamp, channel string, msg string, sentiment int"
RAW_CHAT_MESSAGE = "msg_id long, ts timestamp, channel string, msg string"

SESSION = (
    "name string, game string, dur double, daytime int, fps double, "
    "viewers double, starttime string"
)

WEATHER_RESPONSE = (
    "weather array<struct<main: string>>, main struct<temp: double>, "
    "wind struct<speed: double>, _corrupt_record string"
)
WEATHER_OBS = (
    "hour_key string, place string, main string, wind double, temp double, obs_ts timestamp"
)
FORECAST_RESPONSE = (
    "list array<struct<dt_txt: string, wind: struct<speed: double>, "
    "main: struct<temp: double>, weather: array<struct<main: string>>>>, "
    "_corrupt_record string"
)

PREDICTION_REQUEST = (
    "id long, name string, game string, duration double, daytime string, "
    "fps double, day timestamp"
)
TRAINING_ROW = "id long, text string, target double"

# elements of the three nested columns of the stream-day table
METADATA_ENTRY = (
    "struct<created: timestamp, game: string, status: string, "
    "mature: boolean, fps: double, polls: bigint>"
)
VIEWERS_ENTRY = (
    "struct<minute: timestamp, viewers_sum: bigint, viewers_cnt: bigint, viewers: double>"
)
CHAT_ENTRY = (
    "struct<minute: timestamp, positive: bigint, negative: bigint, neutral: bigint>"
)

# stored tables; ``run``, ``day`` and ``batch`` are folders
CLEAN_SAMPLE = (
    "channel_id long, viewers long, game string, name string, status string, "
    "created timestamp, mature boolean, fps double"
)
STREAM_DAY = (
    "name string, run_ts timestamp, part int, "
    f"metadata array<{METADATA_ENTRY}>, viewerspermin array<{VIEWERS_ENTRY}>, "
    f"chatspermin array<{CHAT_ENTRY}>, run string, day date"
)
SESSION_ROW = (
    "name string, game string, dur double, daytime int, fps double, viewers double, "
    "starttime timestamp, polls long"
)
WEATHER_LOG = f"{WEATHER_OBS}, day date, batch string"
VIEWER_PARTIAL = (
    "name string, day date, minute timestamp, viewers_sum long, viewers_cnt long, viewers double"
)
CHAT_PARTIAL = (
    "name string, day date, minute timestamp, positive long, negative long, neutral long"
)
