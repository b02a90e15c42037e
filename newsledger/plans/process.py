"""Masking or quarantine, analysis, vectors: one function for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.analysis import build_prompt
from newsledger.functions.pii import PiiScanner
from newsledger.functions.vectors import constant_vector
from newsledger.operators.enrich import Factory, attach_analysis, embed, enrich
from newsledger.operators.pii import is_cloud_safe
from newsledger.operators.roles import roles_to_ids
from newsledger.session import materialize
from newsledger.sources.answers import AnswerTable


def process_items(
    items: DataFrame, analyse: Factory, vectorise: Factory, policy: str = "quarantine",
    columns: tuple[str, ...] = ("body",), scanner: PiiScanner | None = None,
    roles: DataFrame | None = None, dim: int = S.EMBEDDING_DIM, partitions: int | None = None,
    keep: bool = True, prompt_chars: int | None = None, answers: AnswerTable | None = None, vectors: AnswerTable | None = None,
) -> DataFrame:
    """Items ready to be written.

    ``policy='quarantine'``: items with personal data in one of ``columns`` get the fixed notice, top
    importance and the constant vector, keep the raw body and never reach the model. ``policy='mask'``:
    those columns are masked, every item is analysed and the masked text is stored.

    ``answers`` and ``vectors`` keep what the models say by content, so equal prompts are asked once and never again in later runs.

    ``prompt_chars`` bounds how much of a body the model gets; by default it gets all.

    No branch is split off and united again; a null prompt keeps an item away from the model. With
    ``keep`` the result is written to the checkpoint folder once, so reading it twice does not call
    the models again.
    """
    if policy not in ("quarantine", "mask"):
        raise ValueError(f"unknown policy {policy!r}")
    scanner = scanner or PiiScanner()
    if policy == "mask":
        masked = {c: scanner.mask(F.col(c)) for c in columns}
        work = items.withColumns({**masked, "is_quarantined": F.lit(False)})
        work = work.withColumn("summary", F.substring("body", 1, S.SUMMARY_CHARS))
    else:
        work = items.withColumn("is_quarantined", ~is_cloud_safe(columns, scanner))
    prompt = F.when(~F.col("is_quarantined"), build_prompt(F.col("title"), F.col("body"), prompt_chars))
    work = enrich(work.withColumn("__prompt", prompt), "__prompt", analyse, partitions=partitions, answers=answers)
    work = attach_analysis(work.drop("__prompt"))
    hit = F.col("is_quarantined")
    work = work.withColumns(
        {
            "summary": F.when(hit, F.lit(S.QUARANTINE_SUMMARY)).otherwise(F.col("summary")),
            "importance": F.when(hit, F.lit(S.QUARANTINE_IMPORTANCE).cast("short")).otherwise(
                F.col("importance")
            ),
            "__text": F.when(~hit, F.concat_ws(" ", "title", "summary")),
        }
    )
    work = embed(work, "__text", vectorise, dim=dim, answers=vectors).drop("__text")
    work = work.withColumn("embedding", F.coalesce("embedding", constant_vector(dim)))
    if keep:
        work = materialize(work)
    if roles is not None:
        work = roles_to_ids(work, roles)
    return work
