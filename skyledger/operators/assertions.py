"""Table assertions: each returns the rows that break it, and a suite of many counts them in one scan of each table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def as_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Repeated key values and how often each occurs; NULL keys are not compared."""
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def as_accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the list and how often each occurs."""
    return df.where(~F.col(col).isin(values)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def as_relationships(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values without a parent and how often each occurs.

    The child is reduced to one row per value first, so neither side of the join has a hot key.
    """
    values = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(key).alias(col)).distinct()
    return values.join(known, col, "left_anti")


def as_non_negative_delay(fact_flight_status: DataFrame) -> DataFrame:
    return fact_flight_status.where(F.col("delay_minutes") < 0)


def as_non_negative_price(fact_booking: DataFrame) -> DataFrame:
    return fact_booking.where(F.col("ticket_price") < 0)


@dataclass(frozen=True)
class Check:
    """One assertion about columns of a model: ``not_null``, ``unique``, ``accepted_values``, ``relationships``, ``non_negative``."""

    model: str
    test: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: tuple[str, str] = ("", "")

    def name(self) -> str:
        return ",".join(self.columns)


def not_null(model: str, column: str) -> Check:
    return Check(model, "not_null", (column,))


def unique(model: str, *columns: str) -> Check:
    return Check(model, "unique", columns)


def accepted(model: str, column: str, values: list[str]) -> Check:
    return Check(model, "accepted_values", (column,), tuple(values))


def related(model: str, column: str, parent: str, key: str) -> Check:
    return Check(model, "relationships", (column,), parent=(parent, key))


def non_negative(model: str, column: str) -> Check:
    return Check(model, "non_negative", (column,))


def _key(columns: tuple[str, ...]) -> Column:
    """The value of a key as text, NULL where a part of it is."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(whole, F.to_json(F.array(*[F.col(c).cast("string") for c in columns])))


def suite(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """``(model, test, column, failures)`` of many checks, with one scan of each model whatever its number of checks.

    A row of a model gives one entry for each of its columns that are checked: the key where values are compared with each
    other, or only whether it breaks the check where they are not. Columns that a relationship compares form one group.
    Entries of all models are counted by group and value, before the shuffle and after it, so neither a hot value nor a
    constant column costs more than a row per task, and each value is shuffled and held once: its counts by column settle
    repeats, unknown values and missing parents without a join.

    ``failures`` counts rows for ``not_null``, ``non_negative`` and ``relationships``, values for the others.
    """
    flags, groups = {}, {}
    for n, c in enumerate(checks):
        if c.test in ("not_null", "non_negative"):
            flags.setdefault(c.model, []).append((-1 - n, c))
            continue
        slots = [(c.model, c.columns)] + ([(c.parent[0], (c.parent[1],))] if c.test == "relationships" else [])
        together = []
        for slot in slots:
            together += [x for x in groups.get(slot, [slot]) if x not in together]
        groups |= dict.fromkeys(together, together)
    number = {id(group): n for n, group in enumerate({id(g): g for g in groups.values()}.values())}
    place = {slot: (number[id(group)], group.index(slot)) for slot, group in groups.items()}
    entries = None
    for model, df in models.items():
        found = []
        for slot, c in flags.get(model, []):
            value = F.col(c.columns[0])
            bad = value.isNull() if c.test == "not_null" else F.coalesce(value < 0, F.lit(False))
            found.append((slot, 0, F.when(bad, "bad")))
        found += [(*at, _key(columns)) for (name, columns), at in place.items() if name == model]
        if found:
            each = [F.struct(F.lit(g).alias("group"), F.lit(at).alias("at"), value.alias("value")) for g, at, value in found]
            one = df.select(F.inline(F.array(*each))).where("value is not null")
            entries = one if entries is None else entries.unionByName(one)
    width = max([len(group) for group in groups.values()], default=1)
    values = entries.groupBy("group", "value").agg(*[F.count_if(F.col("at") == at).alias(f"n{at}") for at in range(width)])
    verdicts = []
    for n, c in enumerate(checks):
        group, at = (-1 - n, 0) if c.test in ("not_null", "non_negative") else place[c.model, c.columns]
        own = F.col(f"n{at}")
        if c.test == "unique":
            failures = F.when(own > 1, 1)
        elif c.test == "accepted_values":
            failures = F.when((own > 0) & ~F.col("value").isin(list(c.values)), 1)
        elif c.test == "relationships":
            failures = F.when(F.col(f"n{place[c.parent[0], (c.parent[1],)][1]}") == 0, own)
        else:
            failures = own
        verdicts.append(F.coalesce(F.sum(F.when(F.col("group") == group, failures)), F.lit(0)).cast("bigint"))
    rows = [F.struct(F.lit(c.model).alias("model"), F.lit(c.test).alias("test"), F.lit(c.name()).alias("column"), v.alias("failures")) for c, v in zip(checks, verdicts, strict=True)]
    return values.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
