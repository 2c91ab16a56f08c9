"""Training sets as of each label's time: what was known of the label's key before it happened."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


@dataclass(frozen=True)
class Source:
    """A feature table: rows of a key that are known from ``known_at`` on."""

    rows: DataFrame
    key: str
    known_at: str
    columns: Sequence[str]


def known_before(
    labels: DataFrame, sources: Mapping[str, Source], key: str, time: str, max_age: int = 90 * DAY, salts: int = 1
) -> DataFrame:
    """Every label with each source's latest row that was known strictly before it and not more than ``max_age``
    seconds earlier, as columns ``<source>_<column>``; NULL where nothing was known.

    A backward as-of join as one union and one window: labels and the rows of all sources are put on one timeline per
    key, on which each source's last row is carried forward; at one time labels come first. The frame is
    bounded by ``max_age``, so the timeline is cut into stretches of that length, each with the source rows of the
    stretch before: all sources cost one shuffle together, a row of a source travels twice, and a key with a long
    history is many groups. Running values are kept, not sliding frames, so a group costs its size. ``salts`` deals
    the labels of a stretch over that many groups, with a copy of the source rows each, for keys with very many
    labels at once.

    Of several rows of a source with one key and time the largest in ``columns`` counts. Labels without a key or a time
    know nothing.
    """

    names = list(sources)
    label = F.struct(*labels.columns).alias("_label")
    at = F.unix_micros(time).alias("_at")
    shown = [f"{n}_{c}" for n in names for c in sources[n].columns]
    kinds = {n: s.rows.select(F.struct(F.unix_micros(s.known_at).alias("at"), *s.columns).alias(n)) for n, s in sources.items()}

    def row(name: str | None):
        """The columns of the sources, of which only ``name`` is set."""
        return [F.col(n) if n == name else F.lit(None).cast(kinds[n].schema[n].dataType).alias(n) for n in names]

    def stretch(offset: int = 0):
        return (F.floor(F.col("_at") / F.lit(max_age * 1_000_000)) + offset).alias("_stretch")

    has = F.col(key).isNotNull() & F.col(time).isNotNull()
    salt = F.pmod(F.xxhash64(*labels.columns), F.lit(salts).cast("long")).alias("_salt")
    told = labels.filter(has).select(F.col(key).alias("_key"), at, label, salt)
    timeline = told.select("_key", "_at", stretch(), "_salt", F.lit(0).alias("_kind"), "_label", *row(None))
    for n in names:
        s = sources[n]
        rows = s.rows.filter(F.col(s.key).isNotNull() & F.col(s.known_at).isNotNull()).select(
            F.col(s.key).alias("_key"),
            F.unix_micros(s.known_at).alias("_at"),
            F.struct(F.unix_micros(s.known_at).alias("at"), *s.columns).alias(n),
        )
        rows = rows.withColumn("_stretch", F.explode(F.array(stretch(), stretch(1))))
        rows = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        timeline = timeline.unionByName(
            rows.select(
                "_key", "_at", "_stretch", "_salt", F.lit(1).alias("_kind"),
                F.lit(None).cast(told.schema["_label"].dataType).alias("_label"), *row(n),
            )
        )
    so_far = Window.partitionBy("_key", "_stretch", "_salt").orderBy("_at", "_kind", *names)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    carried = timeline.select("_at", "_kind", "_label", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names])
    found = []
    for n in names:
        fresh = F.col(f"{n}.at") >= F.col("_at") - max_age * 1_000_000
        found += [F.when(fresh, F.col(f"{n}.{c}")).alias(f"{n}_{c}") for c in sources[n].columns]
    known = carried.filter("_kind = 0").select("_label.*", *found)
    kind = {f.name: f.dataType for f in known.schema.fields}
    return known.unionByName(labels.filter(~has).select("*", *[F.lit(None).cast(kind[c]).alias(c) for c in shown]))
