"""Structured Streaming forms of the batch operators.

The reference works on bounded files only; here the tag-frequency operator also runs
incrementally over photo files as they arrive, with the same DataFrame operators.
"""

from tessera.streaming.tags import start_tag_freq, tag_freq_stream

__all__ = ["start_tag_freq", "tag_freq_stream"]
