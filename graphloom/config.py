"""Settings of a build."""

from __future__ import annotations

from dataclasses import dataclass, field

from .operators.extract import ENTITY_TYPES


@dataclass(frozen=True)
class BuildConfig:
    dataset_dir: str = "./dataset"
    #: Where the answers of extractors are stored; shared by driver and executors.
    work_dir: str = "./work"
    output_dir: str | None = None
    vector_backend: str = "exact"
    embed_dim: int = 64
    batch_embed: int = 16
    min_chunk_tokens: int = 800
    target_chunk_tokens: int = 1000
    max_chunk_tokens: int = 1200
    tail_merge_threshold: int = 400
    min_chunk_chars: int = 120
    kg_backend: str = "rules"
    #: Names the extractor's model; answers are stored under it.
    kg_model: str = ""
    #: Callers at once, and chunks that each asks for in one job.
    max_workers: int = 5
    batch_size: int = 200
    keyword_top_k: int = 5
    #: The longest phrase that is a keyword.
    keyword_words: int = 3
    entity_types: list[str] = field(default_factory=lambda: list(ENTITY_TYPES))

    @property
    def output(self) -> str:
        return str(self.output_dir or f"./artifact_{self.vector_backend}")

    @property
    def work(self) -> str:
        return f"{self.work_dir.rstrip('/')}/{self.output.rstrip('/').rpartition('/')[2]}"
