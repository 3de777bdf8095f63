"""They must equal the data contract's for results to match."""

# Message and timing defaults.
MESSAGE_BYTES = 10 * 1024
NO_DATA_TIMEOUT = "60s"
HEARTBEAT_INTERVAL = "5s"
MAX_ATTEMPTS = 5
FIRST_WAIT_SECONDS = 1
TOOL_LOG_BYTES = 2 * 1024
DEFAULT_STATUS_TOPIC = "engine_status"
DEFAULT_REQUEST_TOPIC = "ingestion_queue_0"
OBJECT_EXTENSION = "nut"

# Message kinds; a key is the stream's prefix followed by the kind.
KIND_INIT = "stream_init"
KIND_RAW = "raw_stream"
KIND_EOF = "stream_eof"

# MIME prefixes and lists.
MJPEG_MIME = "multipart/x-mixed-replace"
DASH_MIME = "application/dash+xml"
TEXT_MIME_TYPES = (
    "application/msword",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/pdf",
    "message/rfc822",
    "application/vnd.ms-outlook",
    "text/plain",
    "text/plain; charset=utf-8",
    "application/vnd.ms-powerpoint",
    "application/rtf",
)
TEXT_SUFFIXES = (".docx", ".doc", ".pdf", ".eml", ".msg", ".txt", ".ppt", ".rtf")
MJPEG_SUFFIXES = (".mjpeg", ".mjpg", ".cgi")

# Fixed values of the public table for sniffing content types, used when a probe carries none:
# type, position of the signature, its bytes in hex, and its mask (None: all bits count).
SIGNATURES = (
    ("image/x-icon", 0, "00000100", None),
    ("image/x-icon", 0, "00000200", None),
    ("image/bmp", 0, "424D", None),
    ("image/gif", 0, "474946383761", None),
    ("image/gif", 0, "474946383961", None),
    ("image/webp", 0, "5249464600000000574542505650", "FFFFFFFF00000000FFFFFFFFFFFF"),
    ("image/png", 0, "89504E470D0A1A0A", None),
    ("image/jpeg", 0, "FFD8FF", None),
    ("audio/aiff", 0, "464F524D0000000041494646", "FFFFFFFF00000000FFFFFFFF"),
    ("audio/mpeg", 0, "494433", None),
    ("application/ogg", 0, "4F67675300", None),
    ("audio/midi", 0, "4D54686400000006", None),
    ("video/avi", 0, "524946460000000041564920", "FFFFFFFF00000000FFFFFFFF"),
    ("audio/wave", 0, "524946460000000057415645", "FFFFFFFF00000000FFFFFFFF"),
    ("video/mp4", 4, "66747970", None),
    ("video/webm", 0, "1A45DFA3", None),
    ("font/ttf", 0, "00010000", None),
    ("font/otf", 0, "4F54544F", None),
    ("font/collection", 0, "74746366", None),
    ("font/woff", 0, "774F4646", None),
    ("font/woff2", 0, "774F4632", None),
    ("application/vnd.ms-fontobject", 34, "4C50", None),
    ("application/x-gzip", 0, "1F8B08", None),
    ("application/zip", 0, "504B0304", None),
    ("application/x-rar-compressed", 0, "526172211A0700", None),
    ("application/pdf", 0, "255044462D", None),
    ("application/postscript", 0, "252150532D41646F62652D", None),
    ("application/rtf", 0, "7B5C727466", None),
    ("text/plain", 0, "FEFF", None),
    ("text/plain", 0, "FFFE", None),
    ("text/plain", 0, "EFBBBF", None),
)
HTML_OPENINGS = (
    "<!DOCTYPE HTML", "<HTML", "<HEAD", "<SCRIPT", "<IFRAME", "<H1", "<DIV", "<FONT", "<TABLE", "<A",
    "<STYLE", "<TITLE", "<B", "<BODY", "<BR", "<P", "<!--",
)

# Tool-log rules in order of precedence: (phrases, error class).
LOG_RULES = (
    (("HTTP error 401", "Server returned 401"), "HTTP error 401"),
    (("HTTP error 403", "Server returned 403"), "HTTP error 403"),
    (("HTTP error 404", "Server returned 404"), "HTTP error 404"),
    (("HTTP error 502", "Server returned 502"), "HTTP error 502"),
    (("HTTP error 503", "Server returned 503"), "HTTP error 503"),
    (("HTTP error 504", "Server returned 504"), "HTTP error 504"),
    (("Connection timed out",), "connection timed out"),
    (("Connection refused",), "connection refused"),
    (("Connection reset by peer",), "connection reset by peer"),
    (("Network is unreachable",), "network is unreachable"),
    (("Name or service not known",), "name or service not known"),
    (("Invalid data found when processing input",), "invalid data found when processing input"),
)

# Failure reason by processing stage; stages are listed in processing order.
STAGE_REASONS = (
    ("writer_setup", "file_write_error"),
    ("api_client", "api_error"),
    ("catalogue_lookup", "url_not_found"),
    ("source_url", "api_not_found"),
    ("mime_probe", "invalid_data"),
    ("window", "invalid_data"),
    ("stream_read", "stream_reader_error"),
    ("stream_write", "file_write_error"),
)
REASON_OTHER = "other"

# Nanoseconds per duration unit; both micro signs are accepted.
DURATION_UNITS = (
    ("ns", 1),
    ("us", 1_000),
    ("µs", 1_000),
    ("μs", 1_000),
    ("ms", 1_000_000),
    ("s", 1_000_000_000),
    ("m", 60_000_000_000),
    ("h", 3_600_000_000_000),
)

# Layout a media-time text is completed from when it is shorter than the layout.
MEDIA_TIME_LAYOUT = "03:04:05.000"
