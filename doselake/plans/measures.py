"""The twenty report measures over the star.

A measure takes a filter context: slicer columns (``by``) and filters
(``where``, column -> accepted values, or a function from the column to a
condition). Filters reach the fact through the dimensions. Population lives in
the municipality dimension alone, so only municipality columns restrict it.

Blank follows the report language: a blank compares, adds and subtracts as zero,
a division by or of a blank is blank, and averages skip blanks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import periods, ranking
from . import dimensions
from .facts import RELATIONS, Relation, Star

Filter = Sequence | Callable[[Column], Column]

DOSES = "total_doses"
POPULATION = "populacao_coberta"
RATE = "taxa_cobertura"
PER_HUNDRED_THOUSAND = 100_000
REAL_PLACES = (dimensions.VALID, dimensions.CAPITAL_REGION)
_MUNICIPALITY = "municipio"
_MEMBER = "chave_municipio"

_RELATION_OF: dict[str, Relation] = {
    column: relation
    for relation in RELATIONS
    for column in (relation.fact_key, relation.key, *relation.attributes)
}


def _relation(column: str) -> Relation:
    try:
        return _RELATION_OF[column]
    except KeyError:
        raise ValueError(f"{column!r} is no column of the star's dimensions") from None


def _owned(columns: Iterable[str], table: str) -> list[str]:
    return [c for c in columns if _relation(c).table == table]


@dataclass(frozen=True)
class Context:
    star: Star
    by: tuple[str, ...] = ()
    where: Mapping[str, Filter] = field(default_factory=dict)

    def sliced(self, *by: str) -> Context:
        return Context(self.star, tuple(by), self.where)

    def without(self, table: str) -> Context:
        """The same context with every filter on ``table`` removed."""
        kept = {c: f for c, f in self.where.items() if _relation(c).table != table}
        return Context(self.star, self.by, kept)

    def without_columns(self, *columns: str) -> Context:
        kept = {c: f for c, f in self.where.items() if c not in columns}
        return Context(self.star, self.by, kept)


def context(
    star: Star, by: Sequence[str] = (), where: Mapping[str, Filter] | None = None
) -> Context:
    ctx = Context(star, tuple(by), dict(where or {}))
    for column in (*ctx.by, *ctx.where):
        _relation(column)
    return ctx


def _apply(df: DataFrame, where: Mapping[str, Filter], columns: Iterable[str]) -> DataFrame:
    for column in columns:
        rule = where[column]
        c = F.col(column)
        df = df.filter(rule(c) if callable(rule) else c.isin(list(rule)))
    return df


# --- building blocks ---------------------------------------------------------------


def _joined_facts(ctx: Context, extra: Sequence[str] = ()) -> DataFrame:
    """Doses at the grain of the keys in use, with the wanted dimension columns.

    The fact is summed to those keys before any dimension is met: the join then
    sees one row per key combination, however many rows a hot key has.
    """
    columns = list(dict.fromkeys((*ctx.by, *ctx.where, *extra)))
    used = [r for r in RELATIONS if any(_relation(c) == r for c in columns)]
    facts = ctx.star.fato.groupBy(*[r.fact_key for r in used]).agg(
        F.sum("qtd_doses").alias(DOSES)
    )
    for r in used:
        wanted = [c for c in columns if c in r.attributes]
        if wanted:
            side = getattr(ctx.star, r.table).select(F.col(r.key).alias("_key"), *wanted)
            facts = facts.join(side, F.col(r.fact_key) == F.col("_key"), "left").drop("_key")
        if r.key in columns and r.key != r.fact_key:
            facts = facts.withColumn(r.key, F.col(r.fact_key))
    return _apply(facts, ctx.where, ctx.where)


def doses(ctx: Context) -> DataFrame:
    return _joined_facts(ctx).groupBy(*ctx.by).agg(F.sum(DOSES).alias(DOSES))


def _members(ctx: Context) -> DataFrame:
    """Municipality dimension under the municipality filters of the context."""
    return _apply(ctx.star.municipio, ctx.where, _owned(ctx.where, _MUNICIPALITY))


def _population(ctx: Context, by: Sequence[str]) -> DataFrame:
    return _members(ctx).groupBy(*by).agg(F.sum("populacao").alias(POPULATION))


def _attach(df: DataFrame, side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal or equally blank slicers; a scalar where there are none."""
    value = [c for c in side.columns if c not in on]
    if not on:
        return df.withColumns({c: side.select(c).scalar() for c in value})
    renamed = side.select(*[F.col(c).alias(f"_{c}") for c in on], *value)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(renamed, condition, "left").drop(*[f"_{c}" for c in on])


def rates(ctx: Context) -> DataFrame:
    """Slicers with doses, population and their ratio."""
    places = _owned(ctx.by, _MUNICIPALITY)
    both = _attach(doses(ctx), _population(ctx, places), places)
    return both.withColumn(RATE, F.try_divide(DOSES, POPULATION))


def member_rates(ctx: Context) -> DataFrame:
    """Rate of every municipality member under the slicers of the context.

    With municipality slicers only, the dimension drives: a member without doses
    stays, with a blank rate. With other slicers, only the pairs of slicer value and
    member that have doses are listed; the blank rest is never spelled out.
    """
    places = _owned(ctx.by, _MUNICIPALITY)
    others = [c for c in ctx.by if c not in places]
    keyed = doses(ctx.sliced(_MEMBER, *others))
    slicers = [c for c in places if c != _MEMBER]
    members = _members(ctx).select(_MEMBER, *slicers, F.col("populacao").alias(POPULATION))
    if others:
        listed = members.join(keyed, _MEMBER)
    else:
        listed = _attach(members, keyed, [_MEMBER])
    return listed.withColumn(RATE, F.try_divide(DOSES, POPULATION))


def _target(ctx: Context, where_meta: Mapping[str, Filter]) -> Column:
    return meta_oficial(ctx.sliced(), where_meta).scalar()


# --- base ---------------------------------------------------------------------------


def total_doses(ctx: Context) -> DataFrame:
    return doses(ctx)


def populacao_coberta(ctx: Context, dedup: bool = False) -> DataFrame:
    """Plain sum over members. ``dedup`` counts a (name, state) pair once, which
    takes the federal district's regions for the one municipality they stand for."""
    places = _owned(ctx.by, _MUNICIPALITY)
    if dedup:
        unique = _members(ctx).select(
            *dict.fromkeys((*places, "nome_municipio", "uf", "populacao"))
        ).distinct()
        population = unique.groupBy(*places).agg(F.sum("populacao").alias(POPULATION))
    else:
        population = _population(ctx, places)
    return _spread_over(ctx, population, places)


def _dimension(ctx: Context, relation: Relation) -> DataFrame:
    """A dimension under its own filters, its key also by the fact's name for it."""
    side = getattr(ctx.star, relation.table)
    if relation.fact_key != relation.key:
        side = side.withColumn(relation.fact_key, F.col(relation.key))
    return _apply(side, ctx.where, _owned(ctx.where, relation.table))


def _combinations(ctx: Context) -> DataFrame:
    """Every combination of slicer values, with doses or without.

    Columns of one dimension combine as its members do, dimensions with one another
    freely; keys that no dimension lists come from the doses. The place dimension is
    unrolled over the value lists of the others, which are short, so no cross join is
    needed and no rows arise but those of the answer.
    """
    used = [r for r in RELATIONS if _owned(ctx.by, r.table)]
    used.sort(key=lambda r: r.table != _MUNICIPALITY)
    grid = None
    for r in used:
        own = _owned(ctx.by, r.table)
        values = _dimension(ctx, r).select(*own).distinct()
        if grid is None:
            grid = values
            continue
        listed = values.agg(F.collect_list(F.struct(*own)))
        grid = grid.withColumn("_values", listed.scalar()).select(
            *grid.columns, F.inline("_values")
        )
    grid = grid.select(*ctx.by)
    if [r.table for r in used] == [_MUNICIPALITY]:
        return grid
    return grid.unionByName(doses(ctx).select(*ctx.by)).distinct()


def _spread_over(ctx: Context, value: DataFrame, on: Sequence[str]) -> DataFrame:
    """A dimension-side value under every slicer; constant over those not in ``on``."""
    if list(ctx.by) == list(on):
        return value
    return _attach(_combinations(ctx), value, on)


def total_municipios(ctx: Context) -> DataFrame:
    """Distinct members that are real places; replaces any choice of record type."""
    real = F.when(F.col("tipo_registro").isin(*REAL_PLACES), F.col(_MEMBER))
    on = [c for c in _owned(ctx.by, _MUNICIPALITY) if c != "tipo_registro"]
    counted = (
        _members(ctx.without_columns("tipo_registro"))
        .groupBy(*on)
        .agg(F.nullif(F.count_distinct(real), F.lit(0)).alias("total_municipios"))
    )
    return _spread_over(ctx, counted, on)


def total_vacinas(ctx: Context) -> DataFrame:
    on = _owned(ctx.by, "vacina")
    members = _dimension(ctx, _relation("chave_vacina"))
    counted = members.groupBy(*on).agg(F.count_distinct("chave_vacina").alias("total_vacinas"))
    return _spread_over(ctx, counted, on)


# --- coverage and target --------------------------------------------------------------


def taxa_cobertura(ctx: Context) -> DataFrame:
    return rates(ctx).select(*ctx.by, RATE)


def cobertura_100mil(ctx: Context) -> DataFrame:
    scaled = F.col(RATE) * PER_HUNDRED_THOUSAND
    return rates(ctx).select(*ctx.by, scaled.alias("cobertura_100mil"))


def meta_oficial(ctx: Context, where_meta: Mapping[str, Filter] | None = None) -> DataFrame:
    """Average of the official targets; filtered only by its own columns, and the
    same under every slicer of the star."""
    rules = where_meta or {}
    average = _apply(ctx.star.meta, rules, rules).agg(
        F.avg("meta_cobertura").alias("meta_oficial")
    )
    return _spread_over(ctx, average, [])


def gap_meta(ctx: Context, where_meta: Mapping[str, Filter] | None = None) -> DataFrame:
    """Percentage points above the target; a blank rate subtracts as zero, also that
    of a slicer value without doses."""
    rated = rates(ctx).select(*ctx.by, RATE)
    if ctx.by:
        rated = _attach(_combinations(ctx), rated, list(ctx.by))
    gap = (F.coalesce(F.col(RATE), F.lit(0.0)) - _target(ctx, where_meta or {})) * 100
    return rated.select(*ctx.by, gap.alias("gap_meta_pp"))


# --- time -----------------------------------------------------------------------------


def _series(ctx: Context) -> tuple[DataFrame, list[str]]:
    """Doses on the whole calendar per non-time slicer; time filters come later,
    since a shifted or running period reaches outside them."""
    groups = [c for c in ctx.by if _relation(c).table != "tempo"]
    monthly = doses(ctx.without("tempo").sliced(*groups, "mes"))
    return periods.on_calendar(monthly, ctx.star.tempo, "mes", groups, DOSES), groups


def _in_time_context(series: DataFrame, ctx: Context) -> DataFrame:
    """The months that the time filters leave, with the time slicers as columns."""
    wanted = _owned(dict.fromkeys((*ctx.by, *ctx.where)), "tempo")
    attributes = [c for c in wanted if c in _relation("mes").attributes]
    if attributes:
        series = series.join(ctx.star.tempo.select("mes", *attributes), "mes")
    if "mes_vacina" in wanted:
        series = series.withColumn("mes_vacina", F.col("mes"))
    return _apply(series, ctx.where, _owned(ctx.where, "tempo"))


def doses_mes_anterior(ctx: Context) -> DataFrame:
    """Doses of the months in context, each moved back by one."""
    series, groups = _series(ctx)
    shifted = periods.previous_month(series, "mes", groups, DOSES, "_before")
    return _in_time_context(shifted, ctx).groupBy(*ctx.by).agg(
        F.sum("_before").alias("doses_mes_anterior")
    )


def variacao_mom(ctx: Context) -> DataFrame:
    """Relative change; a month without doses after one with doses is -1."""
    both = _attach(doses_mes_anterior(ctx), doses(ctx), list(ctx.by))
    before = F.col("doses_mes_anterior")
    change = F.try_divide(F.coalesce(DOSES, F.lit(0)) - before, before)
    return both.select(*ctx.by, change.alias("variacao_mom"))


def doses_ytd(ctx: Context) -> DataFrame:
    """Doses of the year up to the last month in context."""
    series, groups = _series(ctx)
    running = periods.year_to_date(series, "mes", groups, DOSES, "_running")
    return _in_time_context(running, ctx).groupBy(*ctx.by).agg(
        F.max_by("_running", "mes").alias("doses_ytd")
    )


# --- inequality between municipalities -------------------------------------------------


def _spread(ctx: Context) -> DataFrame:
    mean, deviation = F.avg(RATE), F.stddev_pop(RATE)
    return member_rates(ctx).groupBy(*ctx.by).agg(
        mean.alias("cobertura_media"),
        deviation.alias("desvio_padrao"),
        F.try_divide(deviation, mean).alias("coef_variacao"),
    )


def cobertura_media(ctx: Context) -> DataFrame:
    return _spread(ctx).select(*ctx.by, "cobertura_media")


def desvio_padrao(ctx: Context) -> DataFrame:
    return _spread(ctx).select(*ctx.by, "desvio_padrao")


def coef_variacao(ctx: Context) -> DataFrame:
    return _spread(ctx).select(*ctx.by, "coef_variacao")


def ranking_municipio(ctx: Context) -> DataFrame:
    """Rank 1 is the lowest rate, blank counting as zero; a filter on single
    municipalities picks rows to show but does not shrink the ranked set. Other slicers
    give a ranking each."""
    groups = [c for c in ctx.by if c != _MEMBER]
    ranked_set = ctx.without_columns(_MEMBER).sliced(*groups)
    rated = member_rates(ranked_set).select(_MEMBER, *groups, RATE)
    if _owned(groups, _MUNICIPALITY) != groups:
        listed = _combinations(ranked_set.sliced(_MEMBER, *groups))
        rated = _attach(listed, rated, [_MEMBER, *groups])
    scored = rated.select(_MEMBER, *groups, F.coalesce(F.col(RATE), F.lit(0.0)).alias("_score"))
    ranked = ranking.competition_rank(scored, "_score", "ranking", groups).drop("_score")
    return _apply(ranked, ctx.where, [c for c in ctx.where if c == _MEMBER])


def piores_municipios(ctx: Context, n: int) -> DataFrame:
    return ranking.worst(ranking_municipio(ctx), "ranking", _MEMBER, n)


def pct_abaixo_meta(ctx: Context, where_meta: Mapping[str, Filter] | None = None) -> DataFrame:
    """Members below the target over real places: the numerator takes every member
    in context, the denominator only the two real record types.

    Those below are the members in context less those that reach the target, so the
    many pairs without doses, whose blank rate counts as zero, need no rows.
    """
    target = F.coalesce(_target(ctx, where_meta or {}), F.lit(0.0))
    places = _owned(ctx.by, _MUNICIPALITY)
    in_context = _members(ctx).groupBy(*places).agg(F.count_distinct(_MEMBER).alias("_members"))
    reached = (
        member_rates(ctx)
        .withColumn("_target", target)
        .filter(F.coalesce(F.col(RATE), F.lit(0.0)) >= F.col("_target"))
        .groupBy(*ctx.by)
        .agg(F.count_distinct(_MEMBER).alias("_reached"))
    )
    both = _attach(_spread_over(ctx, in_context, places), reached, list(ctx.by))
    both = _attach(both, total_municipios(ctx), list(ctx.by))
    below = F.nullif(F.col("_members") - F.coalesce("_reached", F.lit(0)), F.lit(0))
    return both.select(*ctx.by, F.try_divide(below, "total_municipios").alias("pct_abaixo_meta"))


# --- quality and shares ------------------------------------------------------------------


def pct_nao_municipio_valido(ctx: Context) -> DataFrame:
    """Share of doses on members that are no listed municipality."""
    kind = F.coalesce(F.col("tipo_registro"), F.lit(""))
    other = F.sum(F.when(kind != dimensions.VALID, F.col(DOSES))).alias("_other")
    share = F.try_divide("_other", DOSES).alias("pct_nao_municipio_valido")
    if "tipo_registro" not in (*ctx.by, *ctx.where):
        both = _joined_facts(ctx, ["tipo_registro"]).groupBy(*ctx.by)
        return both.agg(F.sum(DOSES).alias(DOSES), other).select(*ctx.by, share)
    # The condition replaces a choice of record type above the line, not below it.
    on = [c for c in ctx.by if c != "tipo_registro"]
    above = _joined_facts(ctx.without_columns("tipo_registro"), ["tipo_registro"])
    return _attach(doses(ctx), above.groupBy(*on).agg(other), on).select(*ctx.by, share)


def _share(ctx: Context, table: str, key: str, name: str) -> DataFrame:
    """Doses per member over the doses with every filter on ``table`` removed."""
    others = [c for c in ctx.by if _relation(c).table != table]
    slicers = [*others, *(_owned(ctx.by, table) or [key])]
    parts = doses(ctx.sliced(*slicers))
    if _owned(ctx.where, table):
        all_parts = doses(ctx.without(table).sliced(*others))
    else:
        # The same aggregate summed up: its shuffle is reused, not run again.
        all_parts = parts
    whole = all_parts.groupBy(*others).agg(F.sum(DOSES).alias("_whole"))
    return _attach(parts, whole, others).select(
        *slicers, F.try_divide(DOSES, "_whole").alias(name)
    )


def pct_faixa_etaria(ctx: Context) -> DataFrame:
    return _share(ctx, "faixa", "chave_faixa_etaria", "pct_faixa_etaria")


def pct_estrategia(ctx: Context) -> DataFrame:
    return _share(ctx, "estrategia", "chave_estrategia", "pct_estrategia")


def pct_perfil(ctx: Context) -> DataFrame:
    return _share(ctx, "perfil", "chave_perfil", "pct_perfil")


MEASURES: dict[str, Callable[..., DataFrame]] = {
    "d01": total_doses,
    "d02": populacao_coberta,
    "d03": total_municipios,
    "d04": total_vacinas,
    "d05": taxa_cobertura,
    "d06": cobertura_100mil,
    "d07": meta_oficial,
    "d08": gap_meta,
    "d09": doses_mes_anterior,
    "d10": variacao_mom,
    "d11": doses_ytd,
    "d12": cobertura_media,
    "d13": desvio_padrao,
    "d14": coef_variacao,
    "d15": ranking_municipio,
    "d16": pct_abaixo_meta,
    "d17": pct_nao_municipio_valido,
    "d18": pct_faixa_etaria,
    "d19": pct_estrategia,
    "d20": pct_perfil,
}


def measure(
    star: Star,
    name: str,
    by: Sequence[str] = (),
    where: Mapping[str, Filter] | None = None,
    **options,
) -> DataFrame:
    """Evaluate measure ``name`` (``d01`` … ``d20``) in a filter context."""
    return MEASURES[name](context(star, by, where), **options)
