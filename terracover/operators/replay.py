"""The reader's scope and selection after every click, from a log of clicks.

What a click sets stays until another sets it, so a state is the last value set before; that is carried forward over
range partitions, and a user of many clicks is the work of many tasks.
  region    chooses a region (null: none) and clears the state
  state     chooses a state and its region; null clears the state only
  brand     switches a brand on or off
  category  switches all brands of a category on or off
A category is on while one of its brands is; at first all are. Other kinds of clicks, and values that are not known,
change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.colors import palette_for
from ..functions.text import lookup
from .numbering import carried


def _set(when: Column, value: Column) -> Column:
    """A struct where the click sets something (to null, perhaps), else null."""
    return F.when(when, F.struct(value.alias("v")))


def replay(clicks: DataFrame, brands_of: dict[str, list[str]], colours: dict[str, str], user: str, order: list[str]) -> DataFrame:
    """clicks (kind, value, on) with regiao, estado, ativas (brands that are on), rotulo_escopo, rotulo_selecao and rampa."""
    kind, value, on = F.col("kind"), F.col("value"), F.coalesce("on", F.lit(True))
    region_of = lookup(value, tables.REGION_OF_STATE)
    to_region = (kind == "region") & (value.isNull() | value.isin(list(tables.REGIONS)))
    to_state = (kind == "state") & region_of.isNotNull()
    sets = {"_region": F.coalesce(_set(to_region, value), _set(to_state, region_of)), "_state": F.coalesce(_set(to_region, F.lit(None).cast("string")), _set(to_state | ((kind == "state") & value.isNull()), value))}
    brands = [(c, b) for c, own in brands_of.items() for b in own]
    for k, (category, brand) in enumerate(brands):
        sets[f"_on{k}"] = F.when(((kind == "brand") & (value == brand)) | ((kind == "category") & (value == category)), on)
    rows = carried(clicks.withColumns(sets), order, [user], list(sets))
    active = F.filter(F.array(*(F.when(F.coalesce(F.col(f"_on{k}"), F.lit(True)), F.lit(b)) for k, (_, b) in enumerate(brands))), lambda b: b.isNotNull())
    rows = rows.withColumns({"regiao": F.col("_region.v"), "estado": F.col("_state.v"), "ativas": active}).drop(*sets)
    n = F.size("ativas")
    label = F.when(n == len(brands), "todas as bandeiras").when(n == 1, F.col("ativas")[0]).otherwise(F.concat(n.cast("string"), F.lit(" bandeiras")))
    ramps = {b: ",".join(palette_for([b], colours)) for _, b in brands}
    ramp = F.when(n == 1, lookup(F.col("ativas")[0], ramps)).otherwise(F.lit(",".join(palette_for([], colours))))
    place = F.coalesce(lookup(F.col("estado"), tables.STATE_NAMES), F.col("regiao"), F.lit(""))
    return rows.withColumns({"rotulo_escopo": place, "rotulo_selecao": label, "rampa": F.split(ramp, ",")})
