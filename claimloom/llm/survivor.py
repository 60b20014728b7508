"""Best representative of each duplicate group.

Groups are connected components over equal strong keys.  The surviving row is the greatest element of the
group's partial order (the product of completeness, confidence, currency and source trust).  The golden
record is built field by field by currency reasoning: which value follows which is learned from rows that
carry a timestamp, each group's values are put into a partial order by their times and by what was learned,
and the topologically latest value is taken.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import filled, register_key, squeeze, value_or_null
from claimloom.operators.components import connected_components, star_edges
from claimloom.session import materialize

FIELDS = ("lei", "vat", "hr_number", "country", "domain", "address", "status")


def duplicate_groups(rows: DataFrame, keys: Sequence[str] = ("lei", "vat"), id_col: str = "id") -> DataFrame:
    """``(id, first_id)`` of every row in a group of two or more rows connected by equal keys.

    Keys are compared without their notation; nulls, blanks and placeholders connect nothing.  Rows that
    repeat an id count as one row.  An empty table gives an empty result.  However many rows share one key,
    each gets one edge to the key's smallest id.
    """
    keyed = rows.select(F.col(id_col).alias("id"), *[register_key(F.col(k)).alias(f"_key_{i}") for i, k in enumerate(keys)])
    edges = None
    for i, _ in enumerate(keys):
        e = star_edges(keyed, "id", f"_key_{i}")
        edges = e if edges is None else edges.union(e)
    return connected_components(edges).select(F.col("node").alias("id"), F.col("component").alias("first_id"))


def row_trust(claims: DataFrame, trust: DataFrame, subject_type: str = "organization") -> DataFrame:
    """``(id, trust)``: the highest trust among the source types of the claims about each subject.

    Source types are compared without case and surrounding space; unknown ones give no trust.  Claims are
    reduced to one row a subject before the shuffle, so a subject with a large share of them is no burden.
    """
    t = trust.select(squeeze(F.col("source_type")).alias("_st"), F.col("trust").cast("int").alias("trust")).groupBy("_st").agg(F.max("trust").alias("trust"))
    c = claims.where(squeeze(F.col("subject_type")) == subject_type).select(F.col("subject_id").alias("id"), squeeze(F.col("source_type")).alias("_st"))
    return c.where("id is not null").join(t, "_st").groupBy("id").agg(F.max("trust").alias("trust"))


def _scored(rows: DataFrame, groups: DataFrame, claims: DataFrame, trust: DataFrame, fields: Sequence[str]) -> DataFrame:
    some = lambda c, low: F.coalesce(F.col(c), low)
    return (
        rows.select("id", *[F.col(c) for c in dict.fromkeys((*fields, "confidence", "last_verified"))])
        .join(groups, "id")
        .join(row_trust(claims, trust), "id", "left")
        .select(
            "first_id",
            "id",
            *[value_or_null(F.col(f)).alias(f) for f in fields],
            sum((filled(F.col(f)).cast("int") for f in fields), F.lit(0)).alias("n_filled"),
            F.when(F.isnan(some("confidence", F.lit(-1.0))), -1.0).otherwise(some("confidence", F.lit(-1.0))).alias("confidence"),
            F.col("last_verified"),
            some("last_verified", F.lit("0001-01-01 00:00:00").cast("timestamp")).alias("seen"),
            some("trust", F.lit(-1)).alias("trust"),
        )
    )


_CRITERIA = ("n_filled", "confidence", "seen", "trust")


def _greatest_rows(scored: DataFrame, latest: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The row of each group that is greatest in most criteria, among equals the one that holds the most of the
    group's topologically latest values ``latest(first_id, field, value)``."""
    held = _long(scored, fields).join(latest.select("first_id", "field", "value"), ["first_id", "field", "value"])
    held = held.groupBy("id").agg(F.count(F.lit(1)).alias("n_latest"))
    best = scored.groupBy("first_id").agg(*[F.max(c).alias(f"_m_{c}") for c in _CRITERIA])
    met = sum(((F.col(c) == F.col(f"_m_{c}")).cast("int") for c in _CRITERIA), F.lit(0))
    order = F.struct(met.alias("met"), F.coalesce("n_latest", F.lit(0)).alias("n_latest"), *_CRITERIA, (-F.col("id")).alias("neg_id"))
    return scored.join(held, "id", "left").join(best, "first_id").groupBy("first_id").agg(F.max_by("id", order).alias("survivor_id"))


def survivors(rows: DataFrame, claims: DataFrame, trust: DataFrame, keys: Sequence[str] = ("lei", "vat"), fields: Sequence[str] = FIELDS) -> DataFrame:
    """``(first_id, survivor_id)``, one row a group: the row that no other row of the group beats in filled
    fields, confidence, last_verified (null is oldest) or highest trust of the claims about it.

    Where several or none are greatest in all four, those greatest in most of them are compared by currency: the one
    survives that holds the most of the group's topologically latest values (``latest_values``), then the one ahead
    in the order named; full ties go to the smallest id.  Null confidence, time and trust rank lowest.
    """
    scored = materialize(_scored(rows, duplicate_groups(rows, keys), claims, trust, fields), "scored")
    return _greatest_rows(scored, latest_values(scored, fields), fields)


def _long(scored: DataFrame, fields: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    return scored.select("first_id", "id", "confidence", "last_verified", "trust", F.explode(cells).alias("x")).select(
        "first_id", "id", "confidence", "last_verified", "trust", "x.field", "x.value"
    ).where("value is not null")


def learn_precedence(cells: DataFrame) -> DataFrame:
    """``(field, value, next, n)``: ``next`` followed ``value`` in ``n`` groups more than the other way round.

    Learned from timestamped cells only: from the consecutive values of each group, and from each of its values
    and its latest one.  That is two relations a cell, so a large group makes no pairs.  A relation counts once
    a group; where both directions are as frequent nothing is known.  Of several values at one moment the one
    with the highest trust, confidence, then smallest id stands for it.
    """
    timed = cells.where("last_verified is not null")
    steps = timed.groupBy("first_id", "field", "last_verified").agg(F.max_by("value", F.struct("trust", "confidence", (-F.col("id")).alias("n"))).alias("value"))
    w = Window.partitionBy("first_id", "field").orderBy("last_verified")
    follow = steps.select("first_id", "field", "value", F.lead("value").over(w).alias("next"))
    last = steps.groupBy("first_id", "field").agg(F.max_by("value", "last_verified").alias("next"))
    moves = follow.union(steps.join(last, ["first_id", "field"]).select("first_id", "field", "value", "next")).where("value <> next").distinct()
    up = F.col("value") < F.col("next")
    net = moves.groupBy("field", F.least("value", "next").alias("a"), F.greatest("value", "next").alias("b")).agg(F.sum(F.when(up, 1).otherwise(-1)).alias("n")).where("n <> 0")
    first = F.col("n") > 0
    return net.select("field", F.when(first, F.col("a")).otherwise(F.col("b")).alias("value"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("next"), F.abs("n").alias("n"))


def _topological(after: list[list[int]]) -> list[int]:
    """Nodes in topological order; those on a cycle and behind it are missing."""
    waits = [0] * len(after)
    for x in after:
        for j in x:
            waits[j] += 1
    out = [i for i, n in enumerate(waits) if not n]
    for i in out:
        for j in after[i]:
            waits[j] -= 1
            if not waits[j]:
                out.append(j)
    return out


def _reach(after: list[list[int]], starts: Iterable[int]) -> set[int]:
    seen = set(starts)
    todo = list(seen)
    while todo:
        for j in after[todo.pop()]:
            if j not in seen:
                seen.add(j)
                todo.append(j)
    return seen


def latest_value(nodes: Sequence[tuple], relations: Sequence[tuple[str, str, int]]) -> int:
    """Place of the topologically latest of a group's ``nodes(value, seen, trust, confidence, id)``.

    The partial order holds the group's own times and, for values that these do not order, the learned
    ``relations(value, next, n)``; the most frequent come first and one that would close a cycle is left out.
    With timestamps the result is the latest value or a last one of those that follow it, else a last one of
    all.  Ties go by the length of the longest path to it, then trust, confidence, the smallest id.
    """
    at = {x[0]: i for i, x in enumerate(nodes)}
    moments: dict[int, list[int]] = {}
    for i, x in enumerate(nodes):
        if x[1] is not None:
            moments.setdefault(x[1], []).append(i)
    levels = [moments[t] for t in sorted(moments)]
    after: list[list[int]] = [[] for _ in nodes]
    for one, two in zip(levels, levels[1:]):
        # a joint between two moments instead of all pairs of their values
        after.append(two)
        for i in one:
            after[i].append(len(after) - 1)
    learned = []
    for value, following, n in relations:
        i, j = at[value], at[following]
        if nodes[i][1] is None or nodes[j][1] is None or nodes[i][1] == nodes[j][1]:
            learned.append((-n, value, following, i, j))
    whole = [list(x) for x in after]
    for *_, i, j in learned:
        whole[i].append(j)
    if len(_topological(whole)) < len(whole):
        whole = [list(x) for x in after]
        for *_, i, j in sorted(learned):
            if i not in _reach(whole, [j]):
                whole[i].append(j)
    depth = [0] * len(whole)
    for i in _topological(whole):
        for j in whole[i]:
            depth[j] = max(depth[j], depth[i] + (i < len(nodes)))
    open_ = _reach(whole, levels[-1]) if levels else range(len(nodes))
    return max((i for i in open_ if not whole[i]), key=lambda i: (depth[i], nodes[i][2], nodes[i][3], -nodes[i][4]))


def _latest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = []
        for r in f.itertuples(index=False):
            nodes = [(x["value"], x["seen"], x["trust"], x["confidence"], x["id"]) for x in r.nodes]
            i = latest_value(nodes, [] if r.relations is None else [(x["value"], x["next"], x["n"]) for x in r.relations])
            out.append((r.first_id, r.field, nodes[i][0], nodes[i][4]))
        yield pd.DataFrame(out, columns=["first_id", "field", "value", "id"])


def latest_values(scored: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(first_id, field, value, id)``: the topologically latest of each group's values of a field (``latest_value``),
    in the partial order of the group's own times and the precedence learned from all groups, and the value's latest
    row, else the one with the highest trust, confidence, then the smallest id.  The different values of a group are
    collected."""
    cells = _long(scored, fields)
    best = F.max(F.struct(F.unix_micros("last_verified").alias("seen"), "trust", "confidence", (-F.col("id")).alias("n"))).alias("b")
    values = materialize(
        cells.groupBy("first_id", "field", "value").agg(best).select("first_id", "field", "value", "b.seen", "b.trust", "b.confidence", (-F.col("b.n")).alias("id")), "values"
    )
    learned = materialize(learn_precedence(cells), "precedence")
    key = values.select("first_id", "field", "value")
    within = key.join(learned, ["field", "value"]).join(key.withColumnRenamed("value", "next"), ["first_id", "field", "next"])
    relations = within.groupBy("first_id", "field").agg(F.collect_list(F.struct("value", "next", "n")).alias("relations"))
    nodes = values.groupBy("first_id", "field").agg(F.collect_list(F.struct("value", "seen", "trust", "confidence", "id")).alias("nodes"))
    alone = nodes.where("size(nodes) = 1").select("first_id", "field", F.col("nodes")[0]["value"].alias("value"), F.col("nodes")[0]["id"].alias("id"))
    several = nodes.where("size(nodes) > 1").join(relations, ["first_id", "field"], "left")
    return materialize(alone.union(several.mapInPandas(_latest, "first_id bigint, field string, value string, id bigint")), "latest")


def golden_records(rows: DataFrame, claims: DataFrame, trust: DataFrame, keys: Sequence[str] = ("lei", "vat"), fields: Sequence[str] = FIELDS) -> DataFrame:
    """One built record a group: ``first_id, survivor_id``, each field's value and each field's source row.

    A field takes the topologically latest of the group's values (``latest_values``).  A field that is empty in the
    whole group stays null.
    """
    scored = materialize(_scored(rows, duplicate_groups(rows, keys), claims, trust, fields), "scored")
    latest = latest_values(scored, fields)

    def of(f: str) -> Column:
        return F.max(F.when(F.col("field") == f, F.struct("value", "id")))

    wide = latest.groupBy("first_id").agg(*[of(f).alias(f) for f in fields])
    return (
        _greatest_rows(scored, latest, fields)
        .join(wide, "first_id", "left")
        .select("first_id", "survivor_id", *[F.col(f"{f}.value").alias(f) for f in fields], *[F.col(f"{f}.id").alias(f"{f}_from") for f in fields])
    )
