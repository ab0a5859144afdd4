"""Secrets in texts, and who else holds them: only DataFrame functions, no Python on the executors.

Spans.  For every kind, ``split`` gives the text between matches and ``regexp_extract_all`` the matches;
running sums of their lengths are the spans in code points.  Matches too short for their kind are dropped after
matching, so they still keep later matches from overlapping them.

Ownership.  The value of every candidate is hashed, and over the whole corpus each hash is aggregated to the
number of distinct repositories and distinct owners that hold it.  A value of at least ``copied`` owners is a
widely copied example; one of a single owner is owner-specific and, unless it looks made up (fewer than
``DIVERSE`` different characters), live-looking.  Rows are made distinct per (value, repository, owner) before
they are counted, partially aggregated before each shuffle, so a value that a third of all rows hold costs a row per task.

The method adds spans of kind ``key`` (private key blocks' headers and tokens with a well-known issuer prefix).

Results for odd input: a null text is empty and has no spans; equal rows each have a result; a null repository
or owner counts as one unknown holder; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import stored, with_row_id

# Kinds in their listed order, pattern, least length, and which group's length counts.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    "access": (r"AKIA[A-Z0-9]+", 16, 0),
    "hex": (r"[0-9a-f]{32,}", 32, 0),
    "key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----|(?:ghp|gho|ghs|ghu)_[A-Za-z0-9]{36,}|xox[abp]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{32,}", 16, 0),
}
BASE = ("assign", "access", "hex")
COPIED = 3
DIVERSE = 8

_SPAN = "struct<kind:string,place:int,start:bigint,end:bigint,value:string>"


def _spans(text: Column, kind: str) -> Column:
    """Array of ``(kind, place, start, end, value)`` of one kind; most texts stop at the first test."""
    pattern, least, group = KINDS[kind]
    place = list(KINDS).index(kind)
    rx = F.lit(pattern)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, rx, 0)
    sizes = F.transform(hits, lambda m, i: F.struct(F.char_length(F.get(gaps, i)).cast("long").alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.char_length(x["m"]).cast("long")
        value = F.regexp_extract(x["m"], pattern, group) if group else x["m"]
        span = F.struct(F.lit(kind).alias("kind"), F.lit(place).alias("place"), begin.alias("start"), end.alias("end"), value.alias("value"))
        kept = F.when(F.char_length(value) >= least, F.concat(acc["out"], F.array(span.cast(_SPAN)))).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    found = F.aggregate(sizes, start, step)["out"]
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def find_spans(text: Column) -> Column:
    """All spans of a text by start, then kind."""
    null_safe = F.coalesce(text.cast("string"), F.lit(""))
    every = F.concat(*[_spans(null_safe, kind) for kind in KINDS])
    ordered = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    return F.array_sort(ordered)


def with_spans(docs: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``columns``, a row number ``_row`` and ``_spans`` of every row of ``docs``, stored without the texts.

    Of a span's value only its hash and whether it is diverse are stored, so no secret is written to the shared folder."""
    hashed = F.transform(
        find_spans(F.col("text")),
        lambda s: F.struct(
            s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.sha2(s["value"], 256).alias("value_hash"), (F.size(F.array_distinct(F.split(s["value"], ""))) >= DIVERSE).alias("diverse"),
        ),
    )
    return stored(with_row_id(docs, "_row").select(*columns, "_row", hashed.alias("_spans")), name)


def ownership(spans: DataFrame, repository: str, owner: str, copied: int = COPIED) -> DataFrame:
    """``(value_hash, n_repositories, n_owners, live)`` of every candidate value found in the corpus."""
    held = spans.select(F.explode("_spans").alias("s"), F.col(repository).cast("string").alias("r"), F.col(owner).cast("string").alias("o"))
    unknown = F.lit("")
    each = held.select(
        "s.value_hash", "s.diverse",
        F.coalesce("r", unknown).alias("r"), F.coalesce("o", unknown).alias("o"),
    ).distinct()
    by_owner = each.groupBy("value_hash", "diverse", "o").agg(F.count(F.lit(1)).alias("repositories"))
    by_repository = each.select("value_hash", "r").distinct().groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_repositories"))
    owners = by_owner.groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.first("diverse").alias("diverse"))
    return owners.join(by_repository, "value_hash").select(
        "value_hash", "n_repositories", "n_owners", (F.col("n_owners") >= copied).alias("example"), ((F.col("n_owners") < copied) & F.col("diverse")).alias("live")
    )


def scan(docs: DataFrame, repository: str, owner: str, columns: list[str], copied: int = COPIED) -> DataFrame:
    """``columns``, ``_row``, ``_spans`` (array by start, then kind) and per row the number of its candidates that are
    widely copied examples (``n_example``) and owner-specific live-looking ones (``n_live``), with ``live_spans`` (array of
    ``(start, end)`` in code points, by start).  ``docs`` has ``text`` and the two holder columns."""
    keep = list(dict.fromkeys([*columns, repository, owner]))
    spans = with_spans(docs, keep, "secret-spans")
    known = ownership(spans, repository, owner, copied)
    each = spans.where(F.size("_spans") > 0).select("_row", F.explode("_spans").alias("s")).withColumn("value_hash", F.col("s.value_hash"))
    judged = each.join(known, "value_hash").groupBy("_row").agg(
        F.count_if("example").alias("n_example"), F.count_if("live").alias("n_live"), F.max("n_owners").alias("most_owners"),
        F.array_sort(F.collect_list(F.when(F.col("live"), F.struct("s.start", "s.end")))).alias("live_spans"),
    )
    zero = F.lit(0).cast("long")
    return spans.join(judged, "_row", "left").select(
        *columns, "_row", "_spans", F.coalesce("n_example", zero).alias("n_example"), F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("most_owners", zero).alias("most_owners"), F.coalesce("live_spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")).alias("live_spans"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span (array of ``(start, end)`` by start; overlapping ones merge) replaced by ``mask``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"].cast("int") + 1, F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"].cast("int") + 1, F.lit(2**31 - 1)))).otherwise(text)
