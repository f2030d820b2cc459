"""Operators on frames: each takes frames and returns frames, lazily unless it says otherwise."""
