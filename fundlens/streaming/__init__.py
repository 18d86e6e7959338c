from fundlens.streaming.topics import (append_to_topic, drain, emit_heartbeats, heartbeat_messages,
                                       message_text, rate_heartbeat, read_topic)

__all__ = ["append_to_topic", "drain", "emit_heartbeats", "heartbeat_messages", "message_text",
           "rate_heartbeat", "read_topic"]
