"""Session settings and the options of question answering."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession


def session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. Cluster settings come from
    ``spark-submit``; ``conf`` overrides what is set here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class Options:
    """All that changes an answer, in one place; no entry point has defaults
    of its own. Models are functions over pandas frames that are passed beside
    the options; an option that needs one which is not passed is an error.

    dense: also search vectors, and fuse both rankings. semantic_judge: what
    kind of judge is passed, ``llm`` or ``nli``. embed_model: the name that the
    index's vectors must carry. gen_model: the name of the generator.
    """

    top_k: int = 10
    routed_domains: int = 3
    k1: float = 1.5
    b: float = 0.75
    rerank: bool = True
    rerank_min: float = 0.9
    semantic_audit: bool = False
    semantic_judge: str = "llm"
    semantic_min: float = 0.5
    evidence: int = 3
    dense: bool = False
    embed_model: str | None = None
    gen_model: str | None = None
    port: int = 8765

    @classmethod
    def from_settings(cls, values: Mapping[str, str]) -> "Options":
        """From settings such as an environment's: KB_RERANK, KB_RERANK_MIN,
        KB_SEMANTIC_AUDIT, KB_SEMANTIC_JUDGE, KB_EMBED_MODEL, KB_GEN_MODEL,
        KB_PORT. A threshold belongs to the scale of its reranker: coverage
        here is 0 to 1."""
        on = lambda name, default: values[name].strip().lower() in ("1", "true", "yes", "on") if values.get(name) else default
        return cls(
            rerank=on("KB_RERANK", cls.rerank), rerank_min=float(values.get("KB_RERANK_MIN") or cls.rerank_min), semantic_audit=on("KB_SEMANTIC_AUDIT", cls.semantic_audit), semantic_judge=values.get("KB_SEMANTIC_JUDGE") or cls.semantic_judge,
            embed_model=values.get("KB_EMBED_MODEL"), gen_model=values.get("KB_GEN_MODEL"), port=int(values.get("KB_PORT") or cls.port),
        )

    def checked(self, model=None, judge=None, embedder=None) -> "Options":
        if self.semantic_audit and judge is None:
            raise ValueError("semantic_audit needs a judge")
        if self.semantic_judge not in ("llm", "nli"):
            raise ValueError(f"no such judge: {self.semantic_judge}")
        if self.gen_model and model is None:
            raise ValueError(f"no model was passed for {self.gen_model}")
        if self.embed_model and self.dense and embedder is None:
            raise ValueError(f"no embedder was passed for {self.embed_model}")
        return self
