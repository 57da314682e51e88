"""python -m graphloom.cli --dataset DIR --output DIR: builds all tables from a folder of texts.

With ``--ask FILE`` (a JSON array of questions) it puts questions to a build that is there already, and writes their contexts or, given
``--answer``, answers as JSON lines below ``--output``/asked.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from .config import BuildConfig
from .operators.extract import TEXT_LIMIT
from .operators.vector import BACKENDS
from .plans.ask import Retriever
from .plans.build import run_build
from .sources import artifacts, corpus


def named(name: str | None):
    """What ``module:name`` names."""
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    d = BuildConfig()
    p = argparse.ArgumentParser(prog="graphloom", description=__doc__)
    # fixed values: the names and defaults of the options
    p.add_argument("--model", "-m", default=None, help="module:name of an embedding model of a list of strings")
    p.add_argument("--backend", "-b", choices=BACKENDS, default=d.vector_backend)
    p.add_argument("--dataset", "-d", default=d.dataset_dir)
    p.add_argument("--output", "-o", default=None)
    p.add_argument("--work", default=d.work_dir)
    p.add_argument("--min-tokens", type=int, default=d.min_chunk_tokens)
    p.add_argument("--target-tokens", type=int, default=d.target_chunk_tokens)
    p.add_argument("--max-tokens", type=int, default=d.max_chunk_tokens)
    p.add_argument("--tail-merge", type=int, default=d.tail_merge_threshold)
    p.add_argument("--min-chunk-chars", type=int, default=d.min_chunk_chars)
    p.add_argument("--batch-size", type=int, default=d.batch_embed)
    p.add_argument("--max-workers", type=int, default=d.max_workers, help="callers of the extractor or answering model at once")
    p.add_argument("--extractor", default=None, help="module:name of a class of extractors; rules if not given")
    p.add_argument("--kg-backend", choices=["rules", *TEXT_LIMIT], default=None)
    p.add_argument("--kg-model", default=d.kg_model)
    p.add_argument("--ask", default=None, help="a JSON array of questions")
    p.add_argument("--answer", default=None, help="module:name of what makes an answering model of a prompt")
    return p


def parse(argv: list[str] | None = None) -> BuildConfig:
    return configured(parser().parse_args(argv))


def configured(a: argparse.Namespace) -> BuildConfig:
    return BuildConfig(
        dataset_dir=a.dataset, output_dir=a.output, work_dir=a.work, vector_backend=a.backend, batch_embed=a.batch_size, max_workers=a.max_workers,
        min_chunk_tokens=a.min_tokens, target_chunk_tokens=a.target_tokens, max_chunk_tokens=a.max_tokens, tail_merge_threshold=a.tail_merge,
        min_chunk_chars=a.min_chunk_chars, kg_backend=a.kg_backend or ("gpt" if a.extractor else "rules"), kg_model=a.kg_model,
    )


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    config, embedder = configured(a), named(a.model)
    spark = SparkSession.builder.appName("graphloom").getOrCreate()
    if a.ask is None:
        run_build(spark, config, named(a.extractor), embedder)
        return
    questions = corpus.load_questions(spark, a.ask)
    retriever = Retriever(spark, config.output, config.vector_backend, embedder, config.embed_dim)
    found = retriever.answers(questions, named(a.answer), config.max_workers) if a.answer else retriever.contexts(questions.drop("query").withColumnRenamed("question", "query"))
    artifacts.save_json(found, f"{config.output}/asked")


if __name__ == "__main__":
    main()
