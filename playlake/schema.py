"""The play-event record: one definition for batch, stream, JSON and DDL."""

# Field names and types of the event record, in stored order.
PAYLOAD_FIELDS = {
    "artist": "STRING",
    "song": "STRING",
    "duration": "DOUBLE",
    "ts": "BIGINT",
    "userId": "INT",
    "sessionId": "INT",
    "page": "STRING",
    "level": "STRING",
    "location": "STRING",
    "userAgent": "STRING",
    "gender": "STRING",
    "firstName": "STRING",
    "lastName": "STRING",
    "registration": "BIGINT",
    "itemInSession": "INT",
    "status": "INT",
    "method": "STRING",
}
INGEST_FIELDS = {
    "event_ts": "TIMESTAMP",
    "kafka_timestamp": "TIMESTAMP",
    "ingestion_time": "TIMESTAMP",
}
EVENT_FIELDS = {**PAYLOAD_FIELDS, **INGEST_FIELDS}

PAYLOAD_COLUMNS = list(PAYLOAD_FIELDS)
EVENT_COLUMNS = list(EVENT_FIELDS)


def ddl(fields: dict[str, str]) -> str:
    """Schema text accepted by readers, ``from_json`` and CREATE TABLE."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


PAYLOAD_DDL = ddl(PAYLOAD_FIELDS)
EVENT_DDL = ddl(EVENT_FIELDS)
