"""Company facts: nested JSON documents to one long table of facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import SPACES, leading_day, pad_cik, text, unit_matches

_FACT = "struct<start:string,end:string,val:string,accn:string,fy:string,fp:string,form:string,filed:string,frame:string>"
_UNITS = f"map<string,array<{_FACT}>>"
_DOCUMENT = f"struct<cik:string,facts:map<string,map<string,struct<units:{_UNITS}>>>>"
_CONCEPT = f"struct<cik:string,tag:string,units:{_UNITS}>"

_SRC_NS, _SRC_UNIT = 1_000_000_000_000, 1_000_000_000


def _day(c: Column) -> Column:
    return leading_day(F.trim(c, F.lit(SPACES)))


def _fact_columns() -> list[Column]:
    f = F.col("f")
    return [
        _day(f["start"]).alias("start"),
        _day(f["end"]).alias("end"),
        text(f["val"]).try_cast("double").alias("val"),
        text(f["accn"]).alias("accn"),
        text(f["fy"]).try_cast("int").alias("fy"),
        text(f["fp"]).alias("fp"),
        text(f["form"]).alias("form"),
        _day(f["filed"]).alias("filed"),
        text(f["frame"]).alias("frame"),
    ]


def explode_xbrl_facts(docs: DataFrame, body: str = "body", doc_pos: str | None = None, tags: list[str] | None = None) -> DataFrame:
    """Long facts of company documents; with `tags` those tags only, dropped before their units are exploded.

    `src_pos` keeps document order (namespace, unit, list position) and `doc_pos` the order of several
    documents of one company; later ties need both. The document explodes inside the task that parsed it,
    before any shuffle, so one huge company spreads over the following exchanges. The explodes are outer ones,
    since a plain explode infers a size filter that parses the document again; the last filter drops the NULLs.
    """
    order = F.col(doc_pos).cast("long") if doc_pos else F.lit(0).cast("long")
    d = docs.select(F.from_json(F.col(body), _DOCUMENT).alias("d"), order.alias("doc_pos"))
    cik = pad_cik("d.cik")
    ns = d.select(cik.alias("cik"), "doc_pos", F.explode_outer("d.facts").alias("ns", "tags"))
    ns = ns.filter(F.col("ns").isin(fixed.NAMESPACES))
    tagged = ns.select("cik", "doc_pos", "ns", F.explode_outer("tags").alias("tag", "t"))
    if tags is not None:
        tagged = tagged.filter(F.col("tag").isin(tags))
    units = tagged.select("cik", "doc_pos", "ns", "tag", F.posexplode_outer(F.map_entries("t.units")).alias("u_pos", "u"))
    facts = units.select("cik", "doc_pos", "ns", "tag", "u_pos", F.col("u.key").alias("unit"), F.posexplode_outer("u.value").alias("pos", "f"))
    ns_rank = F.when(F.col("ns") == fixed.NAMESPACES[0], 0).otherwise(1).cast("long")
    src = ns_rank * _SRC_NS + F.col("u_pos").cast("long") * _SRC_UNIT + F.col("pos")
    out = facts.select("cik", "ns", "tag", "unit", "doc_pos", src.alias("src_pos"), *_fact_columns())
    return out.filter(F.col("val").isNotNull() & F.col("end").isNotNull())


def read_concept_records(docs: DataFrame, body: str = "body", tags: list[str] | None = None) -> DataFrame:
    """USD records of single-concept documents, with the rank of their tag in the priority list."""
    wanted = tags or fixed.INTEREST_CONCEPT_TAGS
    d = docs.select(F.from_json(F.col(body), _CONCEPT).alias("d"))
    units = d.select(
        pad_cik("d.cik").alias("cik"),
        F.col("d.tag").alias("tag"),
        F.posexplode_outer(F.map_entries("d.units")).alias("u_pos", "u"),
    ).filter(F.col("tag").isin(wanted) & unit_matches("u.key", ["USD"], ["shares"]))
    facts = units.select("cik", "tag", F.posexplode_outer("u.value").alias("src_pos", "f"))
    rank = F.array_position(F.array(*[F.lit(t) for t in wanted]), F.col("tag")) - 1
    out = facts.select("cik", "tag", rank.cast("int").alias("tag_rank"), F.col("src_pos").cast("long").alias("src_pos"), *_fact_columns())
    return out.filter(F.col("val").isNotNull() & F.col("end").isNotNull())
