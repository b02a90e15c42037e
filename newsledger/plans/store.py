"""From items to stored rows, and the whole batch job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger import schema as S
from newsledger.operators.enrich import Factory
from newsledger.operators.quality import ContractCounts
from newsledger.operators.ranking import first_per_group
from newsledger.operators.stored import having, known_keys, upsert_items
from newsledger.plans.collect import Source, collect_entries, items_of
from newsledger.plans.process import process_items
from newsledger.session import materialize
from newsledger.sources.item_table import ERRORS, ItemTable


def write_items(
    table: ItemTable, items: DataFrame, analyse: Factory, vectorise: Factory,
    keys: DataFrame | None = None, counts: ContractCounts | None = None, **options,
) -> None:
    """Processes items and writes them by key, one per key; ``counts`` checks the contract on the rows as they are written.

    ``items`` is kept first unless ``keys`` names its keys (then one per key): it is read for its keys and again for the models. Rows with a new
    key are appended with all their columns. A stored row gets the safe columns, and its roles if ``options`` has roles; only the
    partitions of such keys are rewritten. What is stored for a key depends on its own row alone.
    """
    if keys is None:
        order = [F.col(c).asc() for c in ("url", "title")] + [F.xxhash64("body", "source")]
        items = first_per_group(materialize(items), ["dedup_key"], order, 1)
        keys = items.select("dedup_key")
    known = known_keys(keys, having(table.read(), keys, "dedup_key"), "dedup_key")
    clash = not known.isEmpty()
    done = process_items(items, analyse, vectorise, keep=clash, **options)
    done = done.withColumn("created_at", F.current_timestamp())
    if not clash:
        table.append(done, counts)
        return
    update = [*S.SAFE_COLUMNS, *ERRORS, *(("target_roles",) if options.get("roles") is not None else ())]
    table.merge(done, known, lambda stored, incoming: upsert_items(stored, incoming, update=update), counts)


def retry_failed(table: ItemTable, analyse: Factory, vectorise: Factory, **options) -> None:
    """Calls the models again for stored rows with an error and updates those rows."""
    rows = table.failed().drop(*ERRORS)
    if not rows.isEmpty():
        write_items(table, rows, analyse, vectorise, rows.select("dedup_key"), **options)


def run_batch(
    table: ItemTable, sources: list[Source], analyse: Factory, vectorise: Factory,
    run_id: str | None = None, limit: int | None = None, **options,
) -> str:
    """Collects the new items of all sources and stores them; gives the run's id. ``limit``: entries per source, None for all."""
    run_id = run_id or str(uuid.uuid4())
    entries = collect_entries(sources, table.read(), limit)
    # One entry per key, chosen among narrow rows before any text is joined.
    order = [F.col(c).asc() for c in ("site", "url", "title")]
    entries = first_per_group(entries, ["dedup_key"], order, 1)
    write_items(table, items_of(entries, sources, run_id), analyse, vectorise, entries, **options)
    return run_id
