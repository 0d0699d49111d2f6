"""Structured Streaming: keyed bar state, online learning, replay, sinks."""
