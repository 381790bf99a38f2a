"""Point-in-time event features: what a client did in the app before each loan was paid out.

Joining loans to events would emit every pair of a client. Instead both sides are reduced to one
row per client and day, running sums over the days before give the features, and loans look their
(client, day) up. Work is linear in loans plus events, and a client never has more rows in a task
than there are days, however many loans or events it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import stage
from .skew import hot_weights, lookup_join

PAIRS, SECONDS, TIMED = "_pairs", "_seconds", "_timed"
#: Event types that may become columns, unless the caller says otherwise.
MAX_TYPES = 1_000


def prior_event_types(creditos: DataFrame, eventos: DataFrame, most: int = MAX_TYPES) -> list[str | None]:
    """The event types that occur before at least one loan of their client, sorted, None last.

    A pass of its own over the events, one row per client after the partial aggregate; callers that
    know the types should pass them instead.
    """
    types = [r[0] for r in eventos.select("tipo_evento").distinct().limit(most + 1).collect()]
    if len(types) > most:
        raise ValueError(f"more than {most} event types: pass event_types to choose the columns")
    if not types:
        return []
    loans = creditos.select("cliente_id", "fecha_desembolso")
    per_client = (
        eventos.select("cliente_id", "fecha_evento", "tipo_evento")
        .unionByName(loans, allowMissingColumns=True)
        .where("cliente_id IS NOT NULL")
        .groupBy("cliente_id")
        .agg(
            F.max("fecha_desembolso").alias("last"),
            *[F.min(F.when(F.col("tipo_evento").eqNullSafe(F.lit(t)), F.col("fecha_evento"))).alias(f"first_{i}") for i, t in enumerate(types)],
        )
    )
    seen = per_client.agg(*[F.bool_or(F.col(f"first_{i}") < F.col("last")) for i in range(len(types))]).first()
    return sorted((t for t, s in zip(types, seen) if s), key=lambda t: (t is None, t))


def daily_events(eventos: DataFrame) -> DataFrame:
    """(cliente_id, day, tipo_evento, events, seconds, timed), written once, so that types and counts share one scan of the events."""
    rows = eventos.where("cliente_id IS NOT NULL AND fecha_evento IS NOT NULL")
    rows = rows.groupBy("cliente_id", F.unix_date("fecha_evento").alias("day"), "tipo_evento")
    return stage(rows.agg(F.count("*").alias("events"), F.sum("duracion_sesion_seg").alias("seconds"), F.count("duracion_sesion_seg").alias("timed")), "daily_events")


def prior_event_counts(
    creditos: DataFrame, eventos: DataFrame, event_types: Sequence[str], hot: Mapping | Sequence | None = None
) -> DataFrame:
    """Per loan that has prior events: count per type `n_<i>`, all events, session seconds and timed events.

    An event on the day of the loan is not prior. `hot` names the clients with very many loans. `eventos` may also be what
    `daily_events` made of them.
    """
    if hot is None:
        hot = hot_weights(creditos, "cliente_id")
    kinds = [f"n_{i}" for i in range(len(event_types))]
    measures = [*kinds, PAIRS, SECONDS, TIMED]
    loans = creditos.where("credito_id IS NOT NULL AND cliente_id IS NOT NULL AND fecha_desembolso IS NOT NULL").select(
        "credito_id", "cliente_id", F.unix_date("fecha_desembolso").alias("day")
    )
    if "events" in eventos.columns:
        happened = eventos.select("cliente_id", "day", "tipo_evento", "events", "seconds", "timed", F.lit(False).alias("asked"))
    else:
        happened = eventos.where("cliente_id IS NOT NULL AND fecha_evento IS NOT NULL").select(
            "cliente_id", F.unix_date("fecha_evento").alias("day"), "tipo_evento", F.lit(1).cast("bigint").alias("events"),
            F.col("duracion_sesion_seg").alias("seconds"), F.col("duracion_sesion_seg").isNotNull().cast("bigint").alias("timed"), F.lit(False).alias("asked"),
        )
    many = lambda c: F.coalesce(F.sum(c), F.lit(0))
    daily = (
        happened.unionByName(loans.select("cliente_id", "day", F.lit(True).alias("asked")), allowMissingColumns=True)
        .groupBy("cliente_id", "day")
        .agg(
            *[many(F.when(F.col("tipo_evento") == t, F.col("events"))).alias(n) for n, t in zip(kinds, event_types)],
            many("events").alias(PAIRS),
            F.sum("seconds").alias(SECONDS),
            many("timed").alias(TIMED),
            F.bool_or("asked").alias("asked"),
        )
    )
    before = Window.partitionBy("cliente_id").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
    features = (
        daily.select("cliente_id", "day", "asked", *[F.sum(m).over(before).alias(m) for m in measures])
        .where(F.col("asked") & (F.col(PAIRS) > 0))
        .drop("asked")
    )
    return (
        lookup_join(loans, features, ["cliente_id", "day"], "cliente_id", hot, "inner")
        .groupBy("credito_id")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def event_features_py(
    creditos: DataFrame, eventos: DataFrame, event_types: Sequence[str] | None = None, hot: Mapping | Sequence | None = None, most: int = MAX_TYPES
) -> DataFrame:
    """credito_id, prev_evento_<type>..., session total and mean (unrounded).

    With `event_types=None` the columns are the types found; without any prior event there are no
    columns at all. Events without a type count for the session columns only.
    """
    if event_types is None:
        daily = daily_events(eventos)
        types = [r[0] for r in daily.select("tipo_evento").where("tipo_evento IS NOT NULL").distinct().limit(most + 1).collect()]
        if len(types) > most:
            raise ValueError(f"more than {most} event types: pass event_types to choose the columns")
        types = sorted(types)
        counts = stage(prior_event_counts(creditos, daily, types, hot), "prior_events")
        seen = counts.agg(F.count("*").alias("rows"), *[F.max(f"n_{i}").alias(f"n_{i}") for i in range(len(types))]).first()
        if not seen["rows"]:
            return creditos.select("credito_id").limit(0)
        columns = [(f"n_{i}", t) for i, t in enumerate(types) if seen[f"n_{i}"]]
    else:
        counts = prior_event_counts(creditos, eventos, event_types, hot)
        columns = [(f"n_{i}", t) for i, t in enumerate(event_types)]
    return counts.select(
        "credito_id",
        *[F.col(n).alias(f"prev_evento_{t}") for n, t in columns],
        F.coalesce(SECONDS, F.lit(0)).alias("prev_evento_sesion_seg_tot"),
        F.coalesce(F.try_divide(SECONDS, TIMED), F.lit(0.0)).alias("prev_evento_sesion_seg_avg"),
    )


# Event types of the SQL dialect and its column names.
SQL_EVENT_COLUMNS = {
    "login": "prev_evento_login",
    "simulacion_credito": "prev_evento_simulacion",
    "pago_fallido": "prev_evento_pago_fallido",
    "pago_exitoso": "prev_evento_pago_exitoso",
    "solicitud_soporte": "prev_evento_soporte",
}


def event_features_sql(creditos: DataFrame, eventos: DataFrame, hot: Mapping | Sequence | None = None) -> DataFrame:
    """The SQL dialect: five fixed types, mean session rounded to one digit."""
    counts = prior_event_counts(creditos, eventos, list(SQL_EVENT_COLUMNS), hot)
    return counts.select(
        "credito_id",
        *[F.col(f"n_{i}").alias(name) for i, name in enumerate(SQL_EVENT_COLUMNS.values())],
        F.coalesce(SECONDS, F.lit(0)).alias("prev_evento_sesion_seg_tot"),
        F.coalesce(F.round(F.try_divide(SECONDS, TIMED), 1), F.lit(0.0)).alias("prev_evento_sesion_seg_avg"),
    )
