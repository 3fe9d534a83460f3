"""Job options and their defaults."""

from __future__ import annotations

from dataclasses import dataclass

from metricloom import fixed


@dataclass(frozen=True)
class IngestOptions:
    """Options of one ingest job.

    ``batch_size`` bounds the files a micro-batch takes. ``key_mode`` is
    ``exact`` or ``compat``; ``first_only`` stores only the first sample of
    each incoming series. Input that cannot be split, such as one gzip file or
    one row group, is parsed by few tasks; ``input_tasks`` shuffles it to that
    many first. Other input needs none.
    """

    namespace: str = fixed.REMOTE_NAMESPACE
    batch_size: int = fixed.REMOTE_BATCH_SIZE
    tag_bytes: int = fixed.TAG_VALUE_BYTES
    tag_limit: int = fixed.TAGS_PER_SERIES
    key_mode: str = "exact"
    first_only: bool = False
    input_tasks: int | None = None

    @classmethod
    def for_agent(cls, **changes) -> IngestOptions:
        """Defaults of the agent path."""
        defaults = {
            "namespace": fixed.AGENT_NAMESPACE,
            "batch_size": fixed.AGENT_BATCH_SIZE,
        }
        return cls(**{**defaults, **changes})
