"""Connected components of a link table by alternating large and small stars.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)  Each
round is two joins on pre-aggregated minima, so a hub with millions of links
is never gathered in one group; rounds grow with the logarithm of the longest
chain.  Every round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import stored

_U, _V, _M = "u", "v", "m"


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64(_U, _V).cast("decimal(20,0)"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``; root is the smallest node reachable.

    Links of a node to itself and null ends are ignored; no links give an empty
    table.  Raises if ``max_rounds`` do not suffice (a chain of 2^100 nodes).
    """
    e = stored(links.select(F.greatest(_U, _V).alias(_U), F.least(_U, _V).alias(_V))
               .where(f"{_U} > {_V}").distinct(), "links")
    state = _state(e)
    if not state[0]:
        return e.select(F.col(_U).alias("node"), F.col(_V).alias("root"))
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col(_V).alias(_U), F.col(_U).alias(_V)))
        low = both.groupBy(_U).agg(F.least(F.min(_V), F.col(_U)).alias(_M))
        large = (both.where(f"{_V} > {_U}").join(low, _U)
                 .select(F.col(_V).alias(_U), F.col(_M).alias(_V)).distinct())
        low = large.groupBy(_U).agg(F.min(_V).alias(_M))
        small = (large.join(low, _U)
                 .select(F.explode(F.array(F.struct(F.col(_U).alias(_U), F.col(_M).alias(_V)),
                                           F.struct(F.col(_V).alias(_U), F.col(_M).alias(_V)))).alias("x"))
                 .select("x.*").where(f"{_U} > {_V}").distinct())
        e = stored(small, "links")
        before, state = state, _state(e)
        if state == before:
            return e.select(F.col(_U).alias("node"), F.col(_V).alias("root"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
