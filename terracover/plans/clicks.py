"""Events replayed as clicks on the map's scope and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tables
from ..functions.colors import palette_for
from ..operators.replay import replay
from .registry import query

_REGIONS = list(tables.REGIONS)
_STATES = list(tables.STATE_CODES)
_BRANDS = {"Banco": ["Itaú", "Caixa"], "Cooperativa de Crédito": ["Sicoob", "Ailos"]}
_NAMES = [b for own in _BRANDS.values() for b in own]
_COLOURS = {"Itaú": "#ec7000", "Caixa": "#0070af", "Sicoob": "#003641"}


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"


def _on(k: int) -> str:
    category = k // 2
    return f"coalesce(last_value(CASE WHEN event_type = 'click' AND event_id % 4 = {k} OR event_type = 'purchase' AND event_id % 2 = {category} THEN floor(value) % 3 <> 0 END IGNORE NULLS) OVER w, true)"


_SQL = f"""WITH e AS (SELECT event_id, user_id, ts, event_type, value, {_listed(_REGIONS)}[event_id % 6 + 1] AS region, {_listed(_STATES)}[event_id % 28 + 1] AS state FROM events),
c AS (SELECT *, {_map(tables.REGION_OF_STATE)}[state] AS region_of FROM e),
s AS (SELECT event_id, nullif(last_value(CASE WHEN event_type = 'view' THEN coalesce(region, '-') WHEN event_type = 'signup' AND state IS NOT NULL THEN region_of END IGNORE NULLS) OVER w, '-') regiao,
nullif(last_value(CASE WHEN event_type = 'view' THEN '-' WHEN event_type = 'signup' THEN coalesce(state, '-') END IGNORE NULLS) OVER w, '-') estado,
{', '.join(f'{_on(k)} on{k}' for k in range(4))} FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING)),
a AS (SELECT *, list_filter([{', '.join(f"CASE WHEN on{k} THEN '{b}' END" for k, b in enumerate(_NAMES))}], lambda b: b IS NOT NULL) own FROM s)
SELECT event_id, regiao, estado, array_to_string(own, ',') ativas, coalesce({_map(tables.STATE_NAMES)}[estado], regiao, '') rotulo_escopo,
CASE len(own) WHEN 4 THEN 'todas as bandeiras' WHEN 1 THEN own[1] ELSE len(own) || ' bandeiras' END rotulo_selecao,
CASE WHEN len(own) = 1 THEN {_map({b: ','.join(palette_for([b], _COLOURS)) for b in _NAMES})}[own[1]] ELSE '{','.join(palette_for([], _COLOURS))}' END rampa FROM a"""


@query("scope_replay", _SQL)
def scope_replay(spark, sf):
    """The state, labels and ramp after every event of every user."""
    k, kind = F.col("event_id"), F.col("event_type")
    pick = lambda names, at: F.element_at(F.array(*map(F.lit, names), F.lit(None).cast("string")), (at + 1).cast("int"))
    clicks = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "user_id", "ts",
        F.when(kind == "view", "region").when(kind == "signup", "state").when(kind == "click", "brand").when(kind == "purchase", "category").alias("kind"),
        F.when(kind == "view", pick(_REGIONS, k % 6)).when(kind == "signup", pick(_STATES, k % 28)).when(kind == "click", pick(_NAMES, k % 4)).when(kind == "purchase", pick(list(_BRANDS), k % 2)).alias("value"),
        (F.floor("value") % 3 != 0).alias("on"),
    )
    out = replay(clicks, _BRANDS, _COLOURS, "user_id", ["ts", "event_id"])
    return out.select("event_id", "regiao", "estado", F.array_join("ativas", ",").alias("ativas"), "rotulo_escopo", "rotulo_selecao", F.array_join("rampa", ",").alias("rampa"))
