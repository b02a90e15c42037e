"""Calling the caller's model in Arrow batches.

The engine owns batching, partitioning and error isolation; the caller brings a factory returning a
function from a list of texts to a list of answers. The factory runs once per task, so a client is
opened once per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.functions.analysis import parse_analysis
from newsledger.functions.vectors import safe_vector
from newsledger.sources.answers import AnswerTable

BatchFunction = Callable[[list[str]], list]
Factory = Callable[[], BatchFunction]


# Most rows handed back at once: what a task holds beside Spark's batch does not depend on that batch's length.
MAX_ROWS = 256


def _numbers(answer) -> np.ndarray | None:
    """A flat list of numbers as an array, None for anything else; lists of plain numbers are not looked at one by one."""
    if isinstance(answer, np.ndarray) and answer.ndim == 1 and answer.dtype.kind in "fiu":
        return answer.astype(np.float64)
    if not isinstance(answer, np.ndarray) and set(map(type, answer)) <= {float, int}:
        return np.array(answer, dtype=np.float64)
    if all(isinstance(v, (int, float, np.number)) and not isinstance(v, bool) for v in answer):
        return np.array([float(v) for v in answer], dtype=np.float64)
    return None


def _checked(answer, vectors: bool) -> tuple:
    """(answer, error): the answer as text, or as a flat array of floats; anything else is an error of its row."""
    if answer is None or not vectors and isinstance(answer, str):
        return answer, None
    if vectors and isinstance(answer, (list, tuple, np.ndarray)):
        numbers = _numbers(answer)
        if numbers is not None:
            return numbers, None
    return None, f"TypeError: answer is {type(answer).__name__}, not {'a list of numbers' if vectors else 'text'}"


def _as_arrow(pairs: list[tuple], number: pa.DataType | None) -> pa.StructArray:
    """(answer, error) pairs as a struct; ``number`` is the type of a vector's elements, None for texts."""
    answers, errors = [a for a, _ in pairs], pa.array([e for _, e in pairs], pa.string())
    if number is None:
        found = pa.array(answers, pa.string())
    else:
        offsets = np.cumsum([0, *[0 if a is None else len(a) for a in answers]])
        with np.errstate(over="ignore"):
            values = np.concatenate([np.zeros(0), *[a for a in answers if a is not None]]).astype(number.to_pandas_dtype())
        absent = pa.array([a is None for a in answers], pa.bool_())
        found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, number), mask=absent)
    return pa.StructArray.from_arrays([found, errors], names=["answer", "error"])


def _answers(function: BatchFunction, texts: list[str], vectors: bool = False) -> list[tuple]:
    """(answer, error) per text; after a failed batch each text is tried alone."""
    try:
        answers = list(function(texts))
        if len(answers) != len(texts):
            raise ValueError(f"{len(texts)} texts, {len(answers)} answers")
        return [_checked(a, vectors) for a in answers]
    except Exception as error:  # noqa: BLE001 - a failing row must not fail the job
        if len(texts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [pair for text in texts for pair in _answers(function, [text], vectors)]


def call_model(
    df: DataFrame, text: str, factory: Factory, out: str, error: str,
    answer_type: str = "string", batch_size: int = 32, partitions: int | None = None, answers: AnswerTable | None = None,
) -> DataFrame:
    """Adds the answer ``out`` and the message ``error`` for every row with a non-null ``text``.

    With ``answers`` equal texts are asked once and texts answered in an earlier run not at all; ``df`` is then read twice, so keep it
    if it is costly. Without, every row is a call.

    Only ``text`` travels to Python. ``partitions`` sets the number of calls in flight at the price of
    a shuffle; by default the partitioning stays. The UDF counts as non-deterministic: Spark neither
    duplicates it nor moves it over other operators.
    """

    if answers is not None:
        def ask(texts: DataFrame) -> DataFrame:
            return call_model(texts, "text", factory, "answer", "error", answer_type, batch_size, partitions)

        keyed = df.withColumn("__key", F.sha2(F.col(text), 256))
        texts = keyed.filter(F.col("__key").isNotNull()).select(F.col("__key").alias("key"), F.col(text).alias("text"))
        found = answers.ask(texts, ask, answer_type)
        found = found.select(F.col("key").alias("__key"), F.col("answer").alias(out), F.col("error").alias(error))
        return keyed.join(found, "__key", "left").select(*df.columns, out, error)

    number = None if answer_type == "string" else pa.float64() if "double" in answer_type else pa.float32()

    @F.arrow_udf(f"answer {answer_type}, error string")
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = None
        for batch in batches:
            asked = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
            if len(asked) and function is None:
                function = factory()
            pairs: list[tuple] = []
            done = 0  # rows handed back
            for start in range(0, len(asked), batch_size):
                chunk = asked[start : start + batch_size]
                for i, pair in zip(chunk.tolist(), _answers(function, batch.take(pa.array(chunk)).to_pylist(), number is not None)):
                    pairs += [(None, None)] * (i - done - len(pairs))
                    pairs.append(pair)
                if len(pairs) >= MAX_ROWS:
                    yield _as_arrow(pairs, number)
                    done, pairs = done + len(pairs), []
            pairs += [(None, None)] * (len(batch) - done - len(pairs))
            yield _as_arrow(pairs, number)

    if partitions:
        df = df.repartition(partitions)
    called = df.withColumn("__call", call.asNondeterministic()(F.col(text)))
    return called.withColumns({out: F.col("__call.answer"), error: F.col("__call.error")}).drop("__call")


def enrich(df: DataFrame, prompt: str, factory: Factory, **options) -> DataFrame:
    """Adds ``analysis`` (parsed, or the fallback record) and ``analysis_error`` per non-null prompt.

    Where ``prompt`` is null both are null.
    """
    # Told before the call, so that a prompt which nobody reads later is not joined to its answer.
    marked = df.withColumn("__asked", F.col(prompt).isNotNull())
    called = call_model(marked, prompt, factory, "__raw", "__failed", **options)
    parsed = parse_analysis(F.col("__raw"))
    unreadable = F.when(parsed["is_fallback"], F.lit("answer is not a JSON object"))
    asked = F.col("__asked")
    return called.withColumns(
        {
            "analysis": F.when(asked, parsed),
            "analysis_error": F.when(asked, F.coalesce("__failed", unreadable)),
        }
    ).drop("__raw", "__failed", "__asked")


def embed(
    df: DataFrame, text: str, factory: Factory, out: str = "embedding", dim: int = S.EMBEDDING_DIM,
    error: str = "embedding_error", **options,
) -> DataFrame:
    """Adds a vector of ``dim`` floats per non-null text; a failed or unusable one becomes the constant
    vector, with the reason in ``error``."""
    marked = df.withColumn("__asked", F.col(text).isNotNull())
    called = call_model(marked, text, factory, "__vector", error, "array<float>", **options)
    return called.withColumn(
        out, F.when(F.col("__asked"), safe_vector(F.col("__vector"), dim))
    ).drop("__vector", "__asked")


def attach_analysis(items: DataFrame, analysis: str = "analysis", summary_default=None) -> DataFrame:
    """Copies the answer into the item and marks it analysed; rows without an answer stay as they are.

    ``summary_default`` is used when the answer has no summary (default: the item's own). An absent
    key and an explicit null are treated alike. The model's category and role names are carried over as
    ``category`` and ``role_names``.
    """
    answer = F.col(analysis)
    asked = answer.isNotNull()
    default = F.col("summary") if summary_default is None else summary_default

    def take(value, column: str):
        return F.when(asked, value).otherwise(F.col(column))

    return items.withColumns(
        {
            "summary": take(F.coalesce(answer["summary"], default), "summary"),
            "category": take(F.coalesce(answer["category"], F.col("category")), "category"),
            "importance": take(answer["importance_score"], "importance"),
            "sentiment_score": take(answer["sentiment_score"], "sentiment_score"),
            "tags": take(answer["tags"], "tags"),
            "entities": take(answer["entities"], "entities"),
            "ai_summary": take(answer["ai_summary"], "ai_summary"),
            "role_names": F.when(asked, answer["target_roles"]).otherwise(S.empty_array()),
            "is_analyzed": F.when(asked, F.lit(True)).otherwise(F.col("is_analyzed")),
            "analyzed_at": F.when(asked, F.current_timestamp()),
        }
    ).drop(analysis)
