"""Margin, calendar attributes and the snowflake LEFT JOIN (OLAP table)."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import schema as S
from ledgerflow.functions.columns import parse_yyyymmdd
from ledgerflow.session import looked_up
from ledgerflow.sources.csv_tables import ORDER_COLUMN


# --- S11 ------------------------------------------------------------------------

def add_margin(df: DataFrame) -> DataFrame:
    """VAL_MARGIN = VAL_REVENUES - VAL_COST; table unchanged if either is missing."""
    if not {"VAL_REVENUES", "VAL_COST"} <= set(df.columns):
        return df
    return df.withColumn("VAL_MARGIN", F.col("VAL_REVENUES") - F.col("VAL_COST"))


# --- S12 ------------------------------------------------------------------------

def add_order_calendar(df: DataFrame, date_col: str = "ID_ORDER_DATE") -> DataFrame:
    """ORDER_YEAR, ORDER_MONTH and ISO ORDER_WEEK from the order date."""
    if date_col not in df.columns:
        return df
    d = F.col(date_col)
    if df.schema[date_col].dataType.typeName() not in ("date",):
        d = parse_yyyymmdd(date_col) if df.schema[date_col].dataType.typeName() == "string" else d.cast("date")
        df = df.withColumn(date_col, d)
        d = F.col(date_col)
    return df.withColumns({"ORDER_YEAR": F.year(d), "ORDER_MONTH": F.month(d), "ORDER_WEEK": F.weekofyear(d)})


# --- J1: snowflake join ------------------------------------------------------------

def join_column_names(tables: dict[str, Sequence[str]], root: str,
                      relations: dict = S.RELATIONS) -> dict[tuple[str, str], str]:
    """Final name of every parent column in a depth-first LEFT JOIN walk.

    The key keeps its name; a parent column whose name is already taken gets
    the suffix ``_<PARENT>``.  Works on names only (no data).
    """
    seen = [c for c in tables[root] if c != ORDER_COLUMN]
    names: dict[tuple[str, str], str] = {}

    def walk(child: str) -> None:
        for fk, parent in relations.get(child, ()):
            if fk not in seen or fk not in tables[parent]:
                continue
            for c in tables[parent]:
                if c == fk or c == ORDER_COLUMN:
                    continue
                new = f"{c}_{parent}" if c in seen else c
                names[(parent, c)] = new
                seen.append(new)
            walk(parent)

    walk(root)
    return names


def _renamed(df: DataFrame, table: str, key: str, names: dict) -> DataFrame:
    return df.select(F.col(key), *[F.col(c).alias(names[(table, c)]) for c in df.columns
                                   if (table, c) in names])


def snowflake_join(df: DataFrame, root: str, tables: dict[str, DataFrame],
                   relations: dict = S.RELATIONS, large: Collection[str] = ()) -> DataFrame:
    """Depth-first LEFT JOIN of ``df`` (playing ``root``) with its parents.

    Equi-join on the column that has the same name on both sides.  The
    planner picks broadcast or shuffle joins from its size estimates; the
    tables named in ``large`` are never broadcast.
    """
    names = join_column_names({**{t: d.columns for t, d in tables.items()}, root: df.columns}, root, relations)
    out = df.drop(ORDER_COLUMN) if ORDER_COLUMN in df.columns else df

    def walk(out: DataFrame, child: str) -> DataFrame:
        for fk, parent in relations.get(child, ()):
            if fk not in out.columns or fk not in tables[parent].columns:
                continue
            out = out.join(looked_up(_renamed(tables[parent], parent, fk, names), parent in large), on=fk, how="left")
            out = walk(out, parent)
        return out

    return walk(out, root)


def fanout_report(tables: dict[str, DataFrame], relations: dict = S.RELATIONS, large: Collection[str] = ()) -> DataFrame:
    """(CHILD, FK, PARENT, ROWS_BEFORE, ROWS_AFTER) per relation, computed from
    parent-key multiplicities instead of materialising each join.  The tables
    named in ``large`` are never broadcast."""
    parts = []
    for rel in S.relations(relations):
        child, parent = tables[rel.child], tables[rel.parent]
        if rel.fk not in child.columns or rel.fk not in parent.columns:
            continue
        mult = parent.groupBy(rel.fk).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
        per_key = child.groupBy(rel.fk).agg(F.count(F.lit(1)).alias("n"))
        joined = per_key.join(looked_up(mult, rel.parent in large), on=rel.fk, how="left")
        parts.append(joined.agg(
            F.sum("n").alias("ROWS_BEFORE"),
            F.sum(F.col("n") * F.coalesce(F.col("m") - 1, F.lit(0))).alias("EXTRA"),
        ).select(F.lit(rel.child).alias("CHILD"), F.lit(rel.fk).alias("FK"), F.lit(rel.parent).alias("PARENT"),
                 F.coalesce("ROWS_BEFORE", F.lit(0)).cast("long").alias("ROWS_BEFORE"),
                 (F.coalesce("ROWS_BEFORE", F.lit(0)) + F.coalesce("EXTRA", F.lit(0))).cast("long")
                 .alias("ROWS_AFTER")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- fused foreign-key check + enrichment ------------------------------------------

_OK = "_ok"


def _lookup_view(table: str, pk_tables: dict[str, DataFrame], relations: dict,
                 names: dict, keep: dict | None = None, primary_keys: dict = S.PRIMARY_KEYS,
                 large: Collection[str] = ()) -> DataFrame:
    """A lookup as the final join sees it, keyed by its primary key.

    Carries every primary-key-checked row plus ``_ok``: whether the row also
    survives the lookup's own foreign-key checks.  Columns of its own parents
    are already nulled where that parent row fails its own checks.
    """
    base = pk_tables[table]
    pk = primary_keys[table][0]
    base = base.select(pk, *[c for c in base.columns if c != pk and c != ORDER_COLUMN])
    ok = (keep or {}).get(table, F.lit(True))
    parent_cols: list[str] = []
    for fk, parent in relations.get(table, ()):
        ppk = primary_keys[parent][0]
        if fk not in base.columns or ppk not in pk_tables[parent].columns:      # reported, not checked
            continue
        pv = _lookup_view(parent, pk_tables, relations, names, keep, primary_keys, large)
        cols = [c for c in pv.columns if c not in (ppk, _OK)]
        pv = pv.select(F.col(ppk).alias(fk),
                       *[F.when(F.col(_OK), F.col(c)).alias(c) for c in cols],
                       F.lit(True).alias(f"_hit_{parent}"))
        base = base.withColumn(fk, F.col(fk).cast("string")).join(looked_up(pv, parent in large), on=fk, how="left")
        ok = ok & F.col(fk).isNotNull() & F.coalesce(F.col(f"_hit_{parent}"), F.lit(False))
        parent_cols.extend(cols)
    own = [c for c in base.columns if c != pk and not c.startswith("_hit_") and c not in parent_cols]
    return base.select(pk, *[F.col(c).alias(names.get((table, c), c)) for c in own], *parent_cols,
                       ok.alias(_OK))


def check_and_enrich(fact: DataFrame, fact_name: str, pk_tables: dict[str, DataFrame],
                     relations: dict = S.RELATIONS, keep: dict | None = None,
                     primary_keys: dict = S.PRIMARY_KEYS, large: Collection[str] = ()) -> DataFrame:
    """Foreign-key repair of the fact and the snowflake LEFT JOIN as one
    inner join per fact relation.

    Equal to: drop fact rows whose key is null or absent from the
    primary-key-checked parent, then LEFT JOIN the parents as they are after
    their own foreign-key checks (a parent row that fails its own check
    leaves nulls, as in the sequential procedure).  ``keep`` adds per-lookup
    row conditions applied after the key checks (the null policy).  The fact is shuffled
    once per relation instead of twice.  The lookups named in ``large`` are never broadcast.
    """
    shapes = {t: d.columns for t, d in pk_tables.items()}
    shapes[fact_name] = fact.columns
    names = join_column_names(shapes, fact_name, relations)
    out = fact.drop(ORDER_COLUMN) if ORDER_COLUMN in fact.columns else fact
    # joins that shuffle the fact come first, before the others add their columns; a key that a lookup brings keeps its place
    order = relations.get(fact_name, ())
    if all(fk in out.columns for fk, _ in order):
        order = sorted(order, key=lambda r: r[1] not in large)
    for fk, parent in order:
        ppk = primary_keys[parent][0]
        if fk not in out.columns or ppk not in pk_tables[parent].columns:       # reported, not checked
            continue
        view = _lookup_view(parent, pk_tables, relations, names, keep, primary_keys, large)
        cols = [c for c in view.columns if c not in (ppk, _OK)]
        view = view.select(F.col(ppk).alias(fk), *[F.when(F.col(_OK), F.col(c)).alias(c) for c in cols])
        out = out.withColumn(fk, F.col(fk).cast("string")).join(looked_up(view, parent in large), on=fk, how="inner")
    return out


def olap_column_order(fact_cols: Sequence[str], tables: dict[str, Sequence[str]], root: str,
                      relations: dict = S.RELATIONS) -> list[str]:
    names = join_column_names({**tables, root: fact_cols}, root, relations)
    return [c for c in fact_cols if c != ORDER_COLUMN] + list(names.values())
