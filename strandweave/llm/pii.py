"""Surrogates for personal data: keyed, of the same kind, distinct and consistent.

Entities are found where the texts are read. Their distinct values form a
table; each gets a replacement made from a secret key, and replacements that
fall together, or equal a value that occurs, are drawn again, so that
different entities stay different and every mention of one entity gets the
same replacement. Where a format has no free values left, entities exchange theirs. Only texts that hold entities shuffle; the others pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import pii_rules
from .common import cut, join_counted

ENTITIES = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("kind", "string").add("value", "string"))
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
#: Draws of one entity of a fixed format that may be refused before its space counts as full.
ATTEMPTS = 8
#: Entities of a full space that exchange their values in one group, about.
RING = 1000


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    return docs.toDF(*[f"__c{k}" for k in range(len(docs.columns))]), docs.columns


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs whose text holds entities, with a column __entities of (start, end, kind, value)."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = [], []
            for k, body in enumerate(batch.column(at)):
                entities = pii_rules.find(body.as_py() or "")
                if entities:
                    places.append(k)
                    found.append([dict(zip(("start", "end", "kind", "value"), e, strict=True)) for e in entities])
            if places:
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(places)).columns, pa.array(found, _ARROW)], names=[*batch.schema.names, "__entities"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__entities", ENTITIES)]))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs whose text holds no entities."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not pii_rules.find(body.as_py() or "") for body in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def replacements(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value, surrogate for the distinct (kind, value) of a table, one to one.

    No surrogate occurs as a value of its kind, with one exception: a format
    that leaves few free values (all addresses of a small network occur). What finds
    none there in ATTEMPTS draws exchanges its values (`exchanged`). All
    other kinds draw longer replacements until each has one of its own.
    """

    def draw(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [pii_rules.surrogate(key, k, v, attempt) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "value", "surrogate"])

        return run

    fixed = F.col("kind").isin(*pii_rules.FIXED_FORMAT)
    pending, settled, attempt = entities.select("kind", "value"), None, 0
    taken = entities.select("kind", F.col("value").alias("surrogate"))
    while settled is None or not pending.isEmpty():
        drawn = cut(pending.mapInArrow(draw(attempt), "kind string, value string, surrogate string"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = cut(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"))
        settled = won if settled is None else cut(settled.unionByName(won))
        pending = cut(drawn.select("kind", "value").join(won, ["kind", "value"], "left_anti"))
        attempt += 1
        if attempt == ATTEMPTS:
            full = pending.where(fixed)
            if not full.isEmpty():
                settled = cut(exchanged(full, settled, key))
                pending = pending.where(~fixed)
    return settled


def exchanged(full: DataFrame, settled: DataFrame, key: bytes) -> DataFrame:
    """settled with the entities of full spaces, each of which takes the value of another one of its space.

    Settled surrogates are no values that occur, so what stays one to one among the rest
    is one to one in all. The entities of a space are dealt by a keyed hash into
    rings of about RING; each takes the value of the next in its ring. One that is
    alone in its space changes places with a settled entity: it takes that
    one's surrogate, which takes its value.
    """
    schema = "kind string, value string, surrogate string, space string, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            places = [pii_rules.Draws(key, "ring", *p).below(1 << 32) for p in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pii_rules.space(*p) for p in pairs], pa.string()), pa.array(places, pa.int64())], names=["kind", "value", "surrogate", "space", "place"])

    placed = cut(full.withColumn("surrogate", F.lit(None).cast("string")).mapInArrow(run, schema))
    sizes = cut(placed.groupBy("kind", "space").agg(F.count(F.lit(1)).alias("size")))
    members = placed.drop("surrogate").join(sizes, ["kind", "space"]).withColumn("ring", F.col("place") % F.greatest(F.lit(1), F.expr(f"size div {RING}")))
    ring = Window.partitionBy("kind", "space", "ring").orderBy("place", "value")
    whole = Window.partitionBy("kind", "space", "ring")
    turned = members.where("size > 1").select("kind", "value", F.coalesce(F.lead("value").over(ring), F.min_by("value", F.struct("place", "value")).over(whole)).alias("surrogate"))
    alone = members.where("size = 1").select("kind", "space", F.col("value").alias("own"))
    others = settled.where(F.col("kind").isin(*pii_rules.FIXED_FORMAT)).mapInArrow(run, schema)
    partner = others.join(alone, ["kind", "space"]).groupBy("kind", "space").agg(F.min_by(F.struct("value", "surrogate", "own"), F.struct("place", "value")).alias("p"))
    partner = cut(partner.select("kind", "p.*"))
    swapped = partner.select("kind", "value", F.col("own").alias("surrogate")).unionByName(partner.select("kind", F.col("own").alias("value"), "surrogate"))
    return settled.join(partner, ["kind", "value"], "left_anti").unionByName(turned).unionByName(swapped)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", count: str = "n_entities") -> DataFrame:
    """docs with entities in `text` replaced, and how many there were (a column of that name gives way).

    Null texts stay null, with 0 entities. Repeated rows and repeated idents
    are rows of their own; the same entity gets the same surrogate in all of
    them. An empty table gives an empty one. The key is 1 to 64 secret bytes.
    """
    if not 1 <= len(key) <= 64:
        raise ValueError("the key has 1 to 64 bytes")
    plain, names = _plain(docs.drop(count))
    column = plain.columns[names.index(text)]
    at, width = plain.columns.index(column), len(plain.columns)
    kept = docs.schema[text].dataType
    plain = plain.withColumn(column, F.col(column).cast("string"))
    hits = cut(detect(plain, column).withColumn("__uid", F.monotonically_increasing_id()))
    mentions = hits.select("__uid", F.posexplode("__entities").alias("k", "e")).select("__uid", "k", "e.kind", "e.value")
    entities = cut(mentions.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")))
    both = F.concat_ws("\u0001", "kind", "value")
    new = replacements(entities, key).join(entities, ["kind", "value"]).select(both.alias("entity"), "surrogate", "n")
    told = join_counted(mentions.select("__uid", "k", both.alias("entity")), new, "entity", "n", max(1, hits.count()))
    by_doc = told.groupBy("__uid").agg(F.sort_array(F.collect_list(F.struct("k", "surrogate"))).alias("__new"))  # bounded by one text
    ready = hits.join(by_doc, "__uid").select(*plain.columns, "__entities", F.col("__new.surrogate").alias("__new"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for body, entities, values in zip(batch.column(at), batch.column(width), batch.column(width + 1), strict=True):
                old, parts, last = body.as_py(), [], 0
                for e, value in zip(entities.as_py(), values.as_py(), strict=True):
                    parts += [old[last : e["start"]], pii_rules.rendered(e["kind"], old[e["start"] : e["end"]], value)]
                    last = e["end"]
                texts.append("".join([*parts, old[last:]]))
                counts.append(len(parts) // 2)
            columns = batch.columns[:width]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*batch.schema.names[:width], "__count"])

    done = ready.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("__count", T.LongType())]))
    every = clean(plain, column).withColumn("__count", F.lit(0).cast("long")).unionByName(done)
    return every.withColumn(column, F.col(column).cast(kept)).toDF(*names, count)
