"""Where records come from."""

from millrace.sources.documents import read_documents
from millrace.sources.kafka import kafka_messages, kafka_options, read_kafka
from millrace.sources.match import match

__all__ = ["kafka_messages", "kafka_options", "match", "read_documents", "read_kafka"]
