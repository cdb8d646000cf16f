"""tidelog: event-log processing on Spark DataFrames and Structured Streaming."""

LOG_PARTITION = ("topic", "partition")
LOG_POSITION = ("topic", "partition", "offset")
