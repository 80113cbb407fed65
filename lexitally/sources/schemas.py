"""Schemas, as DDL, of every file the library reads or writes; nothing is inferred."""

COUNTS = "key STRING, n BIGINT"

EXTREMES = "which STRING, word STRING, n BIGINT"

FILES = "name STRING, bytes BIGINT, sha256 STRING"

ORIGINS = "id INT, title STRING, url STRING, download_sha256 STRING, download_bytes BIGINT"

_TOTALS = "created_utc STRING, unique_books INT, copies_per_book BIGINT, total_bytes BIGINT"
_RULES = "normalization STRING, word_rule STRING, char_rule STRING"

HEADER = f"{_TOTALS}, {_RULES}"

MANIFEST = f"{_TOTALS}, sources ARRAY<STRUCT<{ORIGINS}>>, files ARRAY<STRUCT<{FILES}>>, {_RULES}"

EXPECTED = ("wordcount MAP<STRING, BIGINT>, charcount MAP<STRING, BIGINT>, "
            "minmax STRUCT<MIN: ARRAY<STRING>, MAX: ARRAY<STRING>>")

TIMINGS = ("framework STRING, nodes INT, job STRING, repetition INT, seconds DOUBLE, "
           "exit_code INT, verified BOOLEAN, output_sha256 STRING, output_uri STRING")

EVENT = ("Event STRING, `Stage ID` INT, `Task Info` STRUCT<Host: STRING>, "
         "`Task End Reason` STRUCT<Reason: STRING>")

ATTEMPTS = "taskAttempts STRUCT<taskAttempt: ARRAY<STRUCT<state: STRING, nodeHttpAddress: STRING>>>"

STANDALONE_WORKERS = "workers ARRAY<STRUCT<state: STRING, host: STRING>>"

YARN_NODES = "nodes STRUCT<node: ARRAY<STRUCT<state: STRING, nodeHostName: STRING>>>"

# Fixed value: the fields of a run's context line, in the order in which it is written.
CONTEXT = "application_id STRING, master STRING, default_parallelism INT"


def names(ddl: str) -> list[str]:
    """Column names of a flat schema."""
    return [field.split()[0] for field in ddl.split(", ")]
