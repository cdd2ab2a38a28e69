"""SQL text for the checks that are too regular to be written out by hand.

Everything here returns common table expressions for a WITH clause.
"""

from __future__ import annotations

from collections.abc import Sequence


def key_hash(key: str, salt: str = "") -> str:
    """32-bit number from the text of a key."""
    text = f"CAST({key} AS VARCHAR)"
    text = f"'{salt}' || {text}" if salt else text
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def below(key: str, part: int, total: int, salt: str = "") -> str:
    """Whether a key hashes into the first ``part`` of ``total`` equal shares."""
    return f"{key_hash(key, salt)} * {total} < {part} * 4294967296"


def gradient_descent(
    source: str,
    features: Sequence[str],
    loss: str,
    iterations: int,
    step: float,
    reg: float,
    prefix: str = "w",
    fraction: float = 1.0,
    key: str = "k",
) -> str:
    """Weights after each iteration as one-row relations ``{prefix}0 .. {prefix}N``.

    ``source`` has the columns ``features`` and ``y`` in 0/1. With a ``fraction`` below 1
    each step takes the rows whose ``key`` is drawn for it.
    """
    d = range(len(features))
    ctes = [f"{prefix}0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{j}" for j in d) + ")"]
    for i in range(1, iterations + 1):
        dot = " + ".join(f"{features[j]} * w{j}" for j in d)
        if loss == "logistic":
            pull = "1 / (1 + exp(-m)) - y"
        else:
            pull = "CASE WHEN (2 * y - 1) * m < 1 THEN -(2 * y - 1) ELSE 0 END"
        rate = f"({step}::DOUBLE / sqrt({i}))"
        sums = ", ".join(f"avg(p * {features[j]}) AS g{j}" for j in d)
        news = ", ".join(f"w{j} * (1 - {rate} * {reg}) - {rate} * g{j} AS w{j}" for j in d)
        drawn = f" WHERE {key_hash(key, f'0:{i}:')} < {int(fraction * 2**32)}" if fraction < 1 else ""
        ctes.append(
            f"{prefix}{i} AS MATERIALIZED (SELECT {news} FROM {prefix}{i - 1}, (SELECT {sums} FROM ("
            f"SELECT *, {pull} AS p FROM (SELECT s.*, {dot} AS m FROM {source} s, {prefix}{i - 1}{drawn}))))"
        )
    return ", ".join(ctes)


def naive_bayes(
    train: str, features: Sequence[str], smoothing: float, prefix: str = "nb"
) -> str:
    """Multinomial parameters: ``{prefix}_pi(y, pi)`` and ``{prefix}_theta(y, f, theta)``.

    ``train`` has the columns ``features`` and ``y``.
    """
    long = " UNION ALL ".join(
        f"SELECT y, {j} AS f, sum({c})::DOUBLE AS s FROM {train} GROUP BY y"
        for j, c in enumerate(features)
    )
    return f"""
    {prefix}_pi AS (
        SELECT y, ln(count(*) + {smoothing}) - ln((SELECT count(*) FROM {train})
                  + {smoothing} * (SELECT count(DISTINCT y) FROM {train})) AS pi
        FROM {train} GROUP BY y),
    {prefix}_sums AS ({long}),
    {prefix}_theta AS (
        SELECT y, f, ln(s + {smoothing})
                   - ln(sum(s) OVER (PARTITION BY y) + {smoothing} * {len(features)}) AS theta
        FROM {prefix}_sums)
    """


def naive_bayes_scores(
    data: str, key: str, features: Sequence[str], prefix: str = "nb"
) -> str:
    """``{prefix}_pred(key, prediction)``: the class with the largest joint log likelihood."""
    wide = ", ".join(f"max(theta) FILTER (f = {j}) AS t{j}" for j in range(len(features)))
    raw = " + ".join(f"{c} * t{j}" for j, c in enumerate(features))
    return f"""
    {prefix}_wide AS (SELECT y AS c, {wide} FROM {prefix}_theta GROUP BY y),
    {prefix}_joint AS (
        SELECT {key}, c, pi + {raw} AS joint
        FROM {data}, {prefix}_wide JOIN {prefix}_pi p ON p.y = c),
    {prefix}_pred AS (
        SELECT {key}, CAST(arg_max(c, joint) AS DOUBLE) AS prediction
        FROM {prefix}_joint GROUP BY {key})
    """


def tree(
    source: str,
    features: Sequence[str],
    depth: int,
    impurity: str,
    classes: int = 0,
    prefix: str = "t",
    weight: str = "",
    levels: Sequence[int] = (),
) -> str:
    """Greedy binary tree of fixed depth over features with few distinct values.

    ``source`` has a unique ``n``, the features and ``y``. Gives ``{prefix}_pred(n, prediction)``:
    the leaf's majority class, or the leaf's mean for ``variance``. Every value
    present in a node is a candidate, "up to and including it" goes left. ``weight`` is an
    expression for how often a row counts; rows of weight 0 are scored only. For classes
    ``{prefix}_share(n, s0, s1, ...)`` has the class shares of each row's leaf, and
    ``{prefix}_at{level}(n, prediction)`` the majority class in trees of those depths.
    """
    factor = f"{weight} * " if weight else ""
    if impurity == "variance":
        terms = ["1", "y", "y * y"]
    else:
        terms = [f"{factor}(y = {c})::INTEGER" for c in range(classes)]
    k = range(len(terms))
    total = [f"t{i}" for i in k]
    left = [f"l{i}" for i in k]
    right = [f"(t{i} - l{i})" for i in k]

    def amount(s: list[str]) -> str:
        return s[0] if impurity == "variance" else "(" + " + ".join(s) + ")"

    def impure(s: list[str]) -> str:
        """Impurity times weight."""
        if impurity == "variance":
            return f"({s[2]} - {s[1]} * {s[1]} / {s[0]})"
        n = amount(s)
        if impurity == "gini":
            return f"({n} - (" + " + ".join(f"{x} * {x}" for x in s) + f") / {n})"
        return "(-(" + " + ".join(f"CASE WHEN {x} > 0 THEN {x} * log2({x} / {n}) ELSE 0 END" for x in s) + "))"

    counted = f" WHERE {weight} > 0" if weight else ""
    ctes = [f"{prefix}_node0 AS MATERIALIZED (SELECT *, 1 AS node FROM {source})"]
    for level in range(depth):
        rows = f"{prefix}_node{level}"
        long = " UNION ALL ".join(
            f"SELECT node, {j} AS f, CAST({c} AS DOUBLE) AS v, "
            + ", ".join(f"sum({t})::DOUBLE AS a{i}" for i, t in enumerate(terms))
            + f" FROM {rows}{counted} GROUP BY node, {c}"
            for j, c in enumerate(features)
        )
        running = ", ".join(f"sum(a{i}) OVER up AS l{i}, sum(a{i}) OVER every AS t{i}" for i in k)
        value = " ".join(f"WHEN {j} THEN r.{c}" for j, c in enumerate(features))
        ctes += [
            f"{prefix}_stat{level} AS (SELECT node, f, v, {running} FROM ({long}) WINDOW"
            " up AS (PARTITION BY node, f ORDER BY v),"
            " every AS (PARTITION BY node, f))",
            f"{prefix}_best{level} AS MATERIALIZED (SELECT node, f, v FROM ("
            f"SELECT *, {impure(total)} - {impure(left)} - {impure(right)} AS gain"
            f" FROM {prefix}_stat{level} WHERE {amount(right)} > 0)"
            " QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)",
            f"{prefix}_node{level + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN 2 * r.node"
            f" WHEN CASE b.f {value} END <= b.v THEN 2 * r.node ELSE 2 * r.node + 1 END AS node"
            f" FROM {rows} r LEFT JOIN {prefix}_best{level} b ON r.node = b.node)",
        ]
    leaf = f"{prefix}_node{depth}"
    if impurity == "variance":
        value = f"SELECT node, avg(y) AS prediction FROM {leaf} GROUP BY node"
    else:
        value = (
            f"SELECT node, CAST(y AS DOUBLE) AS prediction FROM {leaf}{counted} GROUP BY node, y"
            f" QUALIFY row_number() OVER (PARTITION BY node ORDER BY sum({weight or '1'}) DESC, y) = 1"
        )
    ctes.append(f"{prefix}_pred AS MATERIALIZED (SELECT n, prediction FROM {leaf} JOIN ({value}) USING (node))")
    for level in levels:
        node = f"{prefix}_node{level}"
        ctes.append(
            f"{prefix}_at{level} AS MATERIALIZED (SELECT n, prediction FROM {node} JOIN ("
            f"SELECT node, y AS prediction FROM {node}{counted} GROUP BY node, y"
            f" QUALIFY row_number() OVER (PARTITION BY node ORDER BY sum({weight or '1'}) DESC, y) = 1) USING (node))"
        )
    if classes and not levels:
        # Sibling leaves that predict the same class are one leaf, from the lowest level up.
        ctes.append(
            f"{prefix}_cut{depth} AS MATERIALIZED (SELECT l.*, prediction, {depth} AS top FROM {leaf} l JOIN {prefix}_pred USING (n))"
        )
        for level in range(depth - 1, -1, -1):
            above = f"(PARTITION BY node >> {depth - level})"
            ctes.append(
                f"{prefix}_cut{level} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN max(top) OVER {above} = {level + 1}"
                f" AND min(top) OVER {above} = {level + 1}"
                f" AND min(prediction) OVER {above} = max(prediction) OVER {above} THEN {level} ELSE top END AS top)"
                f" FROM {prefix}_cut{level + 1})"
            )
        sums = ", ".join(f"sum({t})::DOUBLE / sum({weight or '1'}) AS s{c}" for c, t in enumerate(terms))
        place = f"top, node >> ({depth} - top)"
        shares = f"SELECT top, node >> ({depth} - top) AS at, {sums} FROM {prefix}_cut0{counted} GROUP BY {place}"
        names = ", ".join(f"s{c}" for c in range(classes))
        ctes.append(
            f"{prefix}_share AS MATERIALIZED (SELECT n, {names} FROM {prefix}_cut0 r JOIN ({shares}) s"
            f" ON s.top = r.top AND s.at = r.node >> ({depth} - r.top))"
        )
    return ", ".join(ctes)
