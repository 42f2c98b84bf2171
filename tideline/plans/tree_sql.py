"""SQL that grows a decision tree level by level, as the check of trained trees.

Nodes are numbered 1, then 2k and 2k+1. A numeric slot is cut by value, a
categorical one by its values in order of mean label. For 0/1 labels the gini
gain is twice the variance gain, so one formula serves both kinds of tree.
"""

from __future__ import annotations


def grow(base: str, width: int, depth: int, categorical: tuple[int, ...] = ()) -> str:
    """CTEs over ``base`` (columns train, y, x0.. and others): ``leafed`` and ``nodes``.

    ``leafed`` is ``base`` with the node each row ends in; ``nodes`` has every
    node with the slot it splits on (NULL for a leaf), the cut, its size and mean.
    """
    nominal = ", ".join(str(c) for c in categorical) or "-1"
    ctes = [f"rows_0 AS (SELECT *, 1 AS node FROM ({base}))"]
    for level in range(depth):
        ctes += _level(level, width, nominal)
    ctes.append(f"leafed AS (SELECT * FROM rows_{depth})")
    inner = " UNION ALL ".join(
        f"SELECT node, slot, cut FROM best_{level}" for level in range(depth))
    sizes = " UNION ".join(
        f"SELECT node, count(*) AS n, sum(y) / count(*) AS mean FROM rows_{level} WHERE train GROUP BY node"
        for level in range(depth + 1))
    # A leaf is counted again on every level below it; float sums may differ in the last digit.
    ctes.append(f"inner_nodes AS ({inner})")
    ctes.append(
        f"nodes AS (SELECT s.node, any_value(i.slot) AS slot, any_value(i.cut) AS cut, "
        f"any_value(s.n) AS n, any_value(s.mean) AS mean FROM ({sizes}) s "
        f"LEFT JOIN inner_nodes i ON i.node = s.node GROUP BY s.node)")
    return ",\n".join(ctes)


def _level(level: int, width: int, nominal: str) -> list[str]:
    rows, nxt = f"rows_{level}", f"rows_{level + 1}"
    unpivot = " UNION ALL ".join(
        f"SELECT node, {i} AS slot, CAST(x{i} AS DOUBLE) AS x, y FROM {rows} WHERE train"
        for i in range(width))
    value = " ".join(f"WHEN {i} THEN CAST(r.x{i} AS DOUBLE)" for i in range(width))
    return [
        f"hist_{level} AS (SELECT node, slot, x, count(*) AS n, sum(y) AS s, sum(y * y) AS q, "
        f"CASE WHEN slot IN ({nominal}) THEN sum(y) / count(*) ELSE x END AS place "
        f"FROM ({unpivot}) GROUP BY node, slot, x)",
        f"running_{level} AS (SELECT node, slot, place, "
        f"sum(n) OVER below AS nl, sum(s) OVER below AS sl, sum(q) OVER below AS ql, "
        f"sum(n) OVER whole AS nt, sum(s) OVER whole AS st, sum(q) OVER whole AS qt "
        f"FROM hist_{level} WINDOW below AS (PARTITION BY node, slot ORDER BY place "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), whole AS (PARTITION BY node, slot))",
        f"gains_{level} AS (SELECT node, slot, place, (qt / nt - (st / nt) * (st / nt)) "
        f"- nl / nt * (ql / nl - (sl / nl) * (sl / nl)) "
        f"- (nt - nl) / nt * ((qt - ql) / (nt - nl) - ((st - sl) / (nt - nl)) * ((st - sl) / (nt - nl))) "
        f"AS gain FROM (SELECT node, slot, place, CAST(nl AS DOUBLE) AS nl, CAST(sl AS DOUBLE) AS sl, "
        f"CAST(ql AS DOUBLE) AS ql, CAST(nt AS DOUBLE) AS nt, CAST(st AS DOUBLE) AS st, "
        f"CAST(qt AS DOUBLE) AS qt FROM running_{level}) WHERE nl < nt)",
        f"best_{level} AS (SELECT node, slot, place AS cut FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY node ORDER BY gain DESC, slot, place) AS pick FROM gains_{level}) "
        f"WHERE pick = 1 AND gain > 1e-12)",
        f"{nxt} AS (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node "
        f"WHEN CASE WHEN b.slot IN ({nominal}) THEN h.place <= b.cut "
        f"ELSE (CASE b.slot {value} END) <= b.cut END THEN 2 * r.node ELSE 2 * r.node + 1 END AS node "
        f"FROM {rows} r LEFT JOIN best_{level} b ON b.node = r.node "
        f"LEFT JOIN hist_{level} h ON h.node = r.node AND h.slot = b.slot "
        f"AND h.x = (CASE b.slot {value} END))",
    ]
