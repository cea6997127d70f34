"""Options of JSON text."""

# Microseconds must survive the text form; Spark's own default cuts them to milliseconds.
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
