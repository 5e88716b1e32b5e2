"""Sources and sinks: tables, Kafka-shaped messages, payloads, history, model store."""
