"""E1: the full ETL, phases 1-11, as one lazy plan plus an audit table."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import schema as S
from ledgerflow.operators import clean, olap
from ledgerflow.session import has_many_rows, looked_up
from ledgerflow.sources.csv_tables import ORDER_COLUMN, expected_table_report, missing_tables


@dataclass
class EtlConfig:
    fact: str = S.SALES
    relations: dict = field(default_factory=lambda: dict(S.RELATIONS))
    primary_keys: dict = field(default_factory=lambda: dict(S.PRIMARY_KEYS))
    technical_keys: dict = field(default_factory=lambda: dict(S.TECHNICAL_KEYS))
    critical: tuple = S.CRITICAL_NUMERIC
    derived: tuple = S.DERIVED


@dataclass
class EtlResult:
    olap: DataFrame
    tables: dict            # lazily built table states (see _Stages)
    stages: dict            # intermediate table states by phase name
    config: EtlConfig

    def audit(self) -> DataFrame:
        return build_audit(self)


def _fused_allowed(cfg: EtlConfig) -> bool:
    """True when every parent is checked against in its primary-key state,
    i.e. each parent's own relations come after the relations that use it."""
    order = S.relations(cfg.relations)
    first_own = {}
    for i, r in enumerate(order):
        first_own.setdefault(r.child, i)
    return all(first_own.get(r.parent, len(order)) > i for i, r in enumerate(order))


def _check_foreign_keys(tables: dict, cfg: EtlConfig, large: Collection[str] = ()) -> tuple[dict, list]:
    """Sequential FK repair in config order; returns final states and the
    (relation, child state, parent state) seen at each check."""
    state = dict(tables)
    seen = []
    for rel in S.relations(cfg.relations):
        pk = cfg.primary_keys[rel.parent][0]
        seen.append((rel, state[rel.child], state[rel.parent]))
        state[rel.child] = clean.repair_fk(state[rel.child], rel.fk, state[rel.parent], pk, large=rel.parent in large)
    return state, seen


def row_prep(df: DataFrame, name: str, cfg: EtlConfig, date_cols: list[str]) -> DataFrame:
    df = clean.cast_technical_keys(df, cfg.technical_keys.get(name, ()))
    return clean.normalise_dates(df, date_cols)


def lookup_policy(views: dict, date_cols: dict, cfg: EtlConfig) -> dict[str, Column]:
    """The null policy of each lookup as a condition: its date and critical columns are present."""
    keep = {}
    for n, df in views.items():
        drop = [c for c in df.columns if c in set(date_cols[n]) | set(cfg.critical)]
        if drop:
            keep[n] = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drop])
    return keep


class _Stages(dict):
    """Intermediate states, built on first use (the fused OLAP path does not
    need the sequential foreign-key states; the audit does)."""

    def __init__(self, tables: dict, cfg: EtlConfig, keep=None):
        super().__init__()
        self._tables, self._cfg = tables, cfg
        self._keep = keep or (lambda name, df: df)

    def __missing__(self, key):
        t, cfg = self._tables, self._cfg
        if key == "inputs":
            val = dict(t)
        elif key == "large":        # no later state of a lookup has more rows
            val = {n for n, df in t.items() if n != cfg.fact and has_many_rows(df)}
        elif key == "date_cols":
            val = {n: clean.date_columns(df) for n, df in t.items()}
        elif key == "all_dates":
            val = sorted({c for cols in self["date_cols"].values() for c in cols})
        elif key == "deduped":
            # the deduplicated fact feeds every later phase and the audit:
            # ``keep`` may store it once (e.g. as a table in the shared folder)
            val = {n: (self._keep(f"{n}-dedup", clean.dedup_rows(df)) if n == cfg.fact else clean.dedup_rows(df))
                   for n, df in t.items()}
        elif key == "pk":
            val = {n: clean.repair_pk(df, cfg.primary_keys.get(n, ())) for n, df in self["deduped"].items()}
        elif key in ("fk", "fk_seen"):
            self["fk"], self["fk_seen"] = _check_foreign_keys(self["pk"], cfg, self["large"])
            return self[key]
        elif key == "final":
            val = {}
            for n, df in self["fk"].items():
                df = row_prep(df, n, cfg, self["date_cols"][n])
                val[n] = clean.apply_null_policy(df, self["date_cols"][n], cfg.critical)
            val[cfg.fact] = olap.add_margin(val[cfg.fact])
        else:
            raise KeyError(key)
        self[key] = val
        return val


def _fact_after_margin_columns(fact_cols: list[str]) -> list[str]:
    cols = [c for c in fact_cols if c != ORDER_COLUMN]
    if {"VAL_REVENUES", "VAL_COST"} <= set(cols):
        cols.append("VAL_MARGIN")
    return cols


def run_etl(tables: dict[str, DataFrame], cfg: EtlConfig | None = None,
            fused: bool = True, keep=None) -> EtlResult | None:
    """Phases 1-11.  ``keep(name, df) -> df`` may store an intermediate state
    (the deduplicated fact) and return it read back; default keeps it lazy."""
    cfg = cfg or EtlConfig()
    if missing_tables(tables.keys(), {cfg.fact, *cfg.primary_keys}):
        return None
    st = _Stages(tables, cfg, keep)
    date_cols = st["date_cols"]
    pk_state = st["pk"]

    if fused and _fused_allowed(cfg):
        # fact rows: every row step except the FK filter, which the inner joins do
        fact = row_prep(pk_state[cfg.fact], cfg.fact, cfg, date_cols[cfg.fact])
        fact = olap.add_margin(clean.apply_null_policy(fact, date_cols[cfg.fact], cfg.critical))
        views = {n: row_prep(df, n, cfg, date_cols[n]) for n, df in pk_state.items() if n != cfg.fact}
        joined = olap.check_and_enrich(fact, cfg.fact, views, cfg.relations, lookup_policy(views, date_cols, cfg), cfg.primary_keys,
                                       st["large"])
    else:
        final = st["final"]
        joined = olap.snowflake_join(final[cfg.fact], cfg.fact, final, cfg.relations, st["large"])

    shapes = {n: [c for c in d.columns if c != ORDER_COLUMN] for n, d in tables.items()}
    fact_cols = _fact_after_margin_columns(tables[cfg.fact].columns)
    order = olap.olap_column_order(fact_cols, shapes, cfg.fact, cfg.relations)
    joined = joined.select(order)
    st["joined"] = joined
    post = clean.apply_null_policy(joined, st["all_dates"], cfg.critical)
    result = olap.add_order_calendar(post)
    return EtlResult(olap=result, tables=st, stages=st, config=cfg)


# --- S13: audit -------------------------------------------------------------------

def _rows(df: DataFrame, phase: str, table: Column, column: Column, checks: dict[str, str]) -> DataFrame:
    """Turn report columns into audit rows; LEVEL is OK when the count is 0."""
    parts = []
    for check, level in checks.items():
        n = F.col(check).cast("long")
        parts.append(df.select(F.lit(phase).alias("PHASE"), table.alias("TABLE_NAME"), column.alias("COLUMN_NAME"),
                               F.lit(check).alias("CHECK"),
                               (F.lit(level) if level == "INFO" else
                                F.when(n.isNull(), F.lit("WARNING"))          # the column isn't there
                                .when(n > 0, F.lit(level)).otherwise(F.lit("OK"))).alias("LEVEL"),
                               n.alias("N")))
    return reduce(DataFrame.unionByName, parts)


def build_audit(res: EtlResult, phases: tuple = ("LOAD", "DEDUP", "PK", "FK", "TECHNICAL", "DATES",
                                                 "NULLS_PRE", "NULLS_POST")) -> DataFrame:
    cfg, st = res.config, res.stages
    parts = []
    if "LOAD" in phases:
        inputs = _input_tables(res)
        rep = expected_table_report(res.olap.sparkSession, inputs.keys(), dict.fromkeys([cfg.fact, *cfg.primary_keys]))
        parts.append(rep.select(F.lit("LOAD").alias("PHASE"), "TABLE_NAME", F.lit(None).cast("string").alias("COLUMN_NAME"),
                                F.lit("PRESENT").alias("CHECK"),
                                F.when(F.col("PRESENT"), "OK").otherwise("ERROR").alias("LEVEL"),
                                F.col("PRESENT").cast("long").alias("N")))
    if {"DEDUP", "PK"} & set(phases):
        for n, df in _input_tables(res).items():
            parts.append(_key_rows(res, n, df, phases))
    if {"FK", "TECHNICAL", "DATES", "NULLS_PRE"} & set(phases):
        parts += [part for n in st["pk"] if (part := _state_rows(res, n, phases)) is not None]
    if "NULLS_POST" in phases:
        rep = clean.null_policy_report("OLAP", st["joined"], st["all_dates"], cfg.critical, cfg.derived)
        parts.append(_level_rows(rep, "NULLS_POST"))
    return reduce(DataFrame.unionByName, parts)


_ROW = "PHASE string, TABLE_NAME string, COLUMN_NAME string, CHECK string, LEVEL string, N long"


def _audit_row(phase: str, table: str, column: str | None, check: str, level: str, n: Column) -> Column:
    """One audit row; INFO stays, other levels are OK when the count is 0."""
    n = F.coalesce(n, F.lit(0)).cast("long")
    shown = F.lit(level) if level == "INFO" else F.when(n > 0, F.lit(level)).otherwise(F.lit("OK"))
    return F.struct(F.lit(phase).alias("PHASE"), F.lit(table).alias("TABLE_NAME"), F.lit(column).cast("string").alias("COLUMN_NAME"),
                    F.lit(check).alias("CHECK"), shown.alias("LEVEL"), n.alias("N"))


def _key_rows(res: EtlResult, name: str, df: DataFrame, phases: tuple) -> DataFrame:
    """DEDUP and PK rows of a table from one grouped pass over its deduplicated state (beside the count of its input)."""
    cfg, deduped = res.config, res.stages["deduped"][name]
    parts = []
    keys = [pk for pk in cfg.primary_keys.get(name, ()) if pk in deduped.columns]
    missing = [pk for pk in cfg.primary_keys.get(name, ()) if pk not in deduped.columns]
    before = df.agg(F.count(F.lit(1)).alias("before"))
    first = keys[0] if keys else None
    if "DEDUP" in phases or first:
        per_key = deduped.groupBy(clean.to_key(first).alias("k")).agg(F.count(F.lit(1)).alias("n")) if first else \
            deduped.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(None).cast("string"))
        facts = per_key.agg(F.sum("n").alias("after"), F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("nulls"),
                            F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)).alias("again"))
        rows = []
        if "DEDUP" in phases:
            facts = facts.unionByName(before, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("after", "nulls", "again", "before")])
            rows += [_audit_row("DEDUP", name, None, "ROWS_BEFORE", "INFO", F.col("before")),
                     _audit_row("DEDUP", name, None, "REMOVED", "INFO", F.col("before") - F.coalesce("after", F.lit(0)))]
        if "PK" in phases and first:
            rows += [_audit_row("PK", name, first, "NULL_KEYS", "ERROR", F.col("nulls")),
                     _audit_row("PK", name, first, "DUPLICATE_ROWS", "ERROR", F.col("again"))]
        if rows:
            parts.append(facts.select(F.inline(F.array(*rows))))
    if "PK" in phases:
        parts += [_rows(clean.pk_report(name, deduped, pk), "PK", F.col("TABLE_NAME"), F.col("COLUMN_NAME"),
                        {"NULL_KEYS": "ERROR", "DUPLICATE_ROWS": "ERROR"}) for pk in [*keys[1:], *missing]]
    if not parts:
        return df.sparkSession.createDataFrame([], _ROW)
    return reduce(DataFrame.unionByName, parts)


def _state_rows(res: EtlResult, name: str, phases: tuple) -> DataFrame | None:
    """FK, TECHNICAL, DATES and NULLS_PRE rows of a table from one conditional aggregate over one scan.

    The foreign keys are looked up once, all of them, as flags on the rows; a row counts for a check while every earlier
    key of its table was found, which is the state that the check sees in the sequential repair."""
    cfg, st = res.config, res.stages
    df, alive = st["pk"][name], F.lit(True)
    dates, technical = st["date_cols"][name], [k for k in cfg.technical_keys.get(name, ()) if k in st["pk"][name].columns]
    aggs, rows = [], []

    def count(phase, column, check, level, condition):
        alias = f"a{len(aggs)}"
        aggs.append(F.count_if(condition).alias(alias))
        rows.append(_audit_row(phase, name, column, check, level, F.col(alias)))
    for k, (rel, _, parent) in enumerate([s for s in st["fk_seen"] if s[0].child == name]):
        pk = cfg.primary_keys[rel.parent][0]
        if rel.fk not in df.columns or pk not in parent.columns:
            continue
        flag, key = f"_hit{k}", clean.to_key(rel.fk)
        hits = clean.parent_keys(parent, pk, f"_key{k}").distinct().withColumn(flag, F.lit(True))
        df = df.join(looked_up(hits, rel.parent in st["large"]), key == F.col(f"_key{k}"), "left")
        orphan = alive & key.isNotNull() & F.col(flag).isNull()
        if "FK" in phases:
            count("FK", rel.fk, "NULL_FK", "ERROR", alive & key.isNull())
            aggs.append(F.count_distinct(F.when(orphan, key)).alias(f"a{len(aggs)}"))       # only orphans: nulls fall away map-side
            rows.append(_audit_row("FK", name, rel.fk, "ORPHAN_VALUES", "ERROR", F.col(f"a{len(aggs) - 1}")))
            count("FK", rel.fk, "ORPHAN_ROWS", "ERROR", orphan)
        alive = alive & F.col(flag).isNotNull()
    if "TECHNICAL" in phases:
        for c in technical:
            count("TECHNICAL", c, "NULLS", "WARNING", alive & F.col(c).isNull())
    if "DATES" in phases:
        for c in dates:
            eight, far = clean.date_shapes(c)
            count("DATES", c, "N_8_DIGITS", "INFO", alive & F.coalesce(eight, F.lit(False)))
            count("DATES", c, "N_OTHER", "INFO", alive & ~F.coalesce(eight, F.lit(False)))
            count("DATES", c, "N_YEAR_GT_2262", "WARNING", alive & F.coalesce(far, F.lit(False)))
    if "NULLS_PRE" in phases:
        plain = st["pk"][name]
        values = {**{c: clean.to_key(c) for c in technical}, **{c: clean.to_date(plain, c) for c in dates}}
        counts, kinds = clean.null_policy_counts(row_prep(plain, name, cfg, dates), dates, cfg.critical, alive=alive, values=values)
        for c, n in counts.items():
            action, level = clean.policy_of(kinds[c])
            aggs.append(n.alias(f"a{len(aggs)}"))
            rows.append(_audit_row("NULLS_PRE", name, c, f"NULLS_{action}", level, F.col(f"a{len(aggs) - 1}")))
    if not rows:
        return None
    # a column without nulls has no row in NULLS_PRE
    shown = F.filter(F.array(*rows), lambda r: (r["PHASE"] != "NULLS_PRE") | (r["N"] > 0))
    return df.agg(*aggs).select(F.inline(shown))


def _level_rows(rep: DataFrame, phase: str) -> DataFrame:
    return rep.select(F.lit(phase).alias("PHASE"), "TABLE_NAME", "COLUMN_NAME",
                      F.concat(F.lit("NULLS_"), F.col("ACTION")).alias("CHECK"), "LEVEL",
                      F.col("NULLS").alias("N"))


def _input_tables(res: EtlResult) -> dict:
    return res.stages["inputs"]
