"""Structured Streaming form of the histogram operator (the only stream use here).

The source has no stream processing; this package only runs B1 incrementally
over files arriving in a folder, with its state checkpointed under the shared
checkpoint folder.
"""

from parcelmart.streaming.histogram import histogram_stream, run_histogram_once

__all__ = ["histogram_stream", "run_histogram_once"]
