"""Structured Streaming forms of the jobs: stateful processors for W1/W2/W3 and
``foreachBatch`` writers for the multi-output and dynamic sinks."""
