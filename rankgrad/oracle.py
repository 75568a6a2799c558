"""DuckDB SQL twins of the fixtures and of the multi-step operators.

These strings are the independent check: they follow the reference's
per-edge arithmetic (one contribution per raw edge, divided by the raw
out-degree) rather than the folded weights the Spark plans use.
"""

from __future__ import annotations

G_PART = "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem"
G_SKEW = ("SELECT CASE WHEN l_linenumber <= 3 THEN CAST(0 AS BIGINT) ELSE l_partkey END AS src, "
          "l_orderkey AS dst FROM lineitem")
G_NATION = (
    "SELECT c_nationkey AS src, s_nationkey AS dst FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey "
    "JOIN supplier ON l_suppkey = s_suppkey")
G_USER = "SELECT user_id AS src, CAST(FLOOR(value * 10) AS BIGINT) % 150 AS dst FROM events"
G_PAGE = ("SELECT url AS src, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS dst "
          "FROM pages")

LINK_LINES = (
    "SELECT event_id, CASE event_id % 11 "
    "WHEN 0 THEN '# ' || event_type "
    "WHEN 1 THEN event_type || '#' || chr(9) || 'User u' "
    "WHEN 2 THEN '' "
    "WHEN 3 THEN event_type "
    "WHEN 4 THEN event_type || chr(9) || 'x' || chr(9) || 'y' "
    "WHEN 5 THEN event_type || chr(9) "
    "WHEN 6 THEN event_type || chr(9) || 'Category:' || event_type "
    "WHEN 7 THEN event_type || chr(9) || 'Talk:' || event_type "
    "WHEN 8 THEN 'Talk:' || event_type || chr(9) || event_type "
    "ELSE 'U' || CAST(user_id AS VARCHAR) || chr(9) || 'u' || "
    "CAST(CAST(FLOOR(value * 10) AS BIGINT) % 150 AS VARCHAR) END AS value FROM events")

EDGE_LINES = (
    "SELECT CAST(l_partkey AS VARCHAR) || chr(9) || CAST(l_suppkey AS VARCHAR) AS value "
    "FROM lineitem UNION ALL "
    "SELECT '# supplier ' || CAST(s_suppkey AS VARCHAR) || ' ' || s_name AS value FROM supplier")


def clean_links_sql(category_prefix: str = "Category:") -> str:
    """Lower-case, keep two-field lines, pair, namespace filter."""
    return (
        "SELECT f[1] AS src, f[2] AS dst FROM ("
        f"SELECT string_split(lower(value), chr(9)) AS f FROM ({LINK_LINES})) "
        f"WHERE len(f) = 2 AND (NOT contains(f[2], ':') OR starts_with(f[2], '{category_prefix}'))")


def edges_from_edge_lines_sql() -> str:
    """Prefix comment filter, then first two fields."""
    return ("SELECT f[1] AS src, f[2] AS dst FROM ("
            f"SELECT string_split(value, chr(9)) AS f FROM ({EDGE_LINES}) "
            "WHERE NOT starts_with(value, '#'))")


def rank_ctes(graph_sql: str, iterations: int, base: float = 0.15,
              damping: float = 0.85) -> str:
    """``WITH`` clause defining ``e``, ``d`` and ranks ``r0 .. r{iterations}``."""
    ctes = [f"e AS ({graph_sql})",
            "d AS (SELECT src, COUNT(*) AS deg FROM e GROUP BY src)",
            "r0 AS (SELECT DISTINCT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM e)"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"r{i} AS (SELECT e.dst AS node, {base} + {damping} * SUM(r.rank / d.deg) AS rank "
            f"FROM e JOIN d ON e.src = d.src JOIN r{i - 1} r ON e.src = r.node "
            "GROUP BY e.dst)")
    return "WITH " + ",\n".join(ctes)


def pagerank_sql(graph_sql: str, iterations: int) -> str:
    return rank_ctes(graph_sql, iterations) + \
        f"\nSELECT node, ROUND(rank, 6) AS rank FROM r{iterations}"


# ---- vectors, training ---------------------------------------------------

ORDER_KEY = "(vec_id * 7919) % 10007, vec_id"

VEC_LONG = (
    "xl AS (SELECT vec_id, label, j, CAST(v AS DOUBLE) AS v FROM ("
    "SELECT vec_id, label, UNNEST(range(len(embedding))) AS j, UNNEST(embedding) AS v "
    "FROM embeddings))")


def layout_sql(shards: int, batch: int, where: str = "TRUE") -> str:
    """CTEs ``ord``, ``padded``, ``lay``: positions, padding, shard, batch
    over the embedding rows matching ``where``."""
    return (
        f"ord AS (SELECT vec_id, label, row_number() OVER (ORDER BY {ORDER_KEY}) - 1 AS pos "
        f"FROM embeddings WHERE {where}),\n"
        "cnt AS (SELECT COUNT(*) AS n FROM ord),\n"
        "padded AS (SELECT vec_id, label, pos FROM ord UNION ALL "
        "SELECT vec_id, label, pos + (SELECT n FROM cnt) FROM ord "
        f"WHERE pos < (({shards} - (SELECT n FROM cnt) % {shards}) % {shards})),\n"
        f"lay AS (SELECT vec_id, label, pos, CAST(pos % {shards} AS INTEGER) AS shard, "
        f"pos // {shards} AS shard_pos, (pos // {shards}) // {batch} AS batch_id FROM padded)")


def sgd_ctes(steps: int, shards: int, batch: int, lr: float = 0.1, mu: float = 0.9,
             wd: float = 0.0001, classes: int = 10, where: str = "TRUE",
             extra: tuple[str, ...] = (), feat: str = "xl") -> list[str]:
    """CTEs of ``steps`` SGD steps from zero parameters, unrolled; the final
    parameters are ``p{steps}(k, j, w)`` with ``j = d`` the bias, and ``x1``
    holds every row's features plus the constant bias input.

    Gradient per step: each shard's mean over its batch rows, divided by the
    shard count and summed (all-reduce mean). Training rows: ``where``;
    features: the long table ``feat(vec_id, j, v)``, defined by ``extra``
    CTEs (which may use ``xl``, the raw features) when not ``xl`` itself.
    """
    ctes = [layout_sql(shards, batch, where), VEC_LONG, *extra,
            f"x1 AS (SELECT vec_id, j, v FROM {feat} UNION ALL "
            "SELECT vec_id, len(embedding) AS j, CAST(1.0 AS DOUBLE) AS v FROM embeddings)",
            "dim AS (SELECT MAX(j) AS dj FROM x1)",
            "p0 AS (SELECT k, UNNEST(range(dj + 1)) AS j, CAST(0.0 AS DOUBLE) AS w FROM "
            f"(SELECT UNNEST(range({classes})) AS k, MAX(dj) AS dj FROM dim))"]
    for t in range(steps):
        ctes += [
            f"b{t} AS (SELECT pos, vec_id, label, shard FROM lay WHERE batch_id = {t})",
            f"z{t} AS (SELECT b.pos, b.shard, b.label, p.k, SUM(x1.v * p.w) AS z FROM b{t} b "
            f"JOIN x1 ON x1.vec_id = b.vec_id JOIN p{t} p ON p.j = x1.j "
            "GROUP BY b.pos, b.shard, b.label, p.k)",
            f"m{t} AS (SELECT pos, MAX(z) AS mx FROM z{t} GROUP BY pos)",
            f"s{t} AS (SELECT z.pos, SUM(EXP(z.z - m.mx)) AS se FROM z{t} z "
            f"JOIN m{t} m ON z.pos = m.pos GROUP BY z.pos)",
            f"q{t} AS (SELECT z.pos, z.shard, z.k, EXP(z.z - m.mx) / s.se - "
            "CASE WHEN z.k = z.label THEN 1.0 ELSE 0.0 END AS dz FROM "
            f"z{t} z JOIN m{t} m ON z.pos = m.pos JOIN s{t} s ON z.pos = s.pos)",
            f"n{t} AS (SELECT shard, COUNT(*) AS n FROM b{t} GROUP BY shard)",
            f"g{t} AS (SELECT q.k, x1.j, SUM(q.dz * x1.v / n.n) / {shards} AS g FROM q{t} q "
            f"JOIN b{t} b ON q.pos = b.pos JOIN x1 ON x1.vec_id = b.vec_id "
            f"JOIN n{t} n ON n.shard = q.shard GROUP BY q.k, x1.j)",
        ]
        if t == 0:
            ctes.append(f"v1 AS (SELECT p.k, p.j, g.g + {wd} * p.w AS v FROM p0 p "
                        "JOIN g0 g ON p.k = g.k AND p.j = g.j)")
        else:
            ctes.append(f"v{t + 1} AS (SELECT p.k, p.j, {mu} * v.v + g.g + {wd} * p.w AS v "
                        f"FROM p{t} p JOIN g{t} g ON p.k = g.k AND p.j = g.j "
                        f"JOIN v{t} v ON p.k = v.k AND p.j = v.j)")
        ctes.append(f"p{t + 1} AS (SELECT p.k, p.j, p.w - {lr} * v.v AS w FROM p{t} p "
                    f"JOIN v{t + 1} v ON p.k = v.k AND p.j = v.j)")
    return ctes


def sgd_sql(steps: int, shards: int, batch: int, **kw) -> str:
    """Final parameters ``(k, j, w)`` after ``steps`` unrolled SGD steps."""
    return ("WITH " + ",\n".join(sgd_ctes(steps, shards, batch, **kw)) +
            f"\nSELECT CAST(k AS INTEGER) AS k, CAST(j AS INTEGER) AS j, ROUND(w, 6) AS w "
            f"FROM p{steps}")


def train_eval_sql(steps: int, shards: int, batch: int, train_where: str, test_where: str,
                   eval_batch: int, extra: tuple[str, ...] = (), train_feat: str = "xl",
                   test_feat: str = "xl") -> str:
    """Train ``steps`` steps on ``train_where`` rows, then evaluate on
    ``test_where`` rows: mean of batch-mean losses (batches in id order),
    correct count, row count, accuracy in percent."""
    ctes = sgd_ctes(steps, shards, batch, where=train_where, extra=extra, feat=train_feat)
    ctes += [
        f"xt AS (SELECT vec_id, j, v FROM {test_feat} UNION ALL SELECT vec_id, len(embedding) "
        "AS j, CAST(1.0 AS DOUBLE) AS v FROM embeddings)",
        f"tsc AS (SELECT x.vec_id, e.label, p.k, SUM(x.v * p.w) AS z FROM xt x "
        f"JOIN embeddings e ON e.vec_id = x.vec_id JOIN p{steps} p ON p.j = x.j "
        f"WHERE {test_where.replace('vec_id', 'x.vec_id')} GROUP BY x.vec_id, e.label, p.k)",
        "tmx AS (SELECT vec_id, MAX(z) AS m FROM tsc GROUP BY vec_id)",
        "tce AS (SELECT s.vec_id, s.label, LN(SUM(EXP(s.z - m.m))) - "
        "(MAX(CASE WHEN s.k = s.label THEN s.z END) - MAX(m.m)) AS loss, "
        "MIN(CASE WHEN s.z = m.m THEN s.k END) AS pred FROM tsc s JOIN tmx m "
        "ON s.vec_id = m.vec_id GROUP BY s.vec_id, s.label)",
        "tb AS (SELECT loss, pred = label AS hit, (row_number() OVER (ORDER BY vec_id) - 1) "
        f"// {eval_batch} AS batch FROM tce)",
        "tbm AS (SELECT batch, AVG(loss) AS l, SUM(CAST(hit AS BIGINT)) AS c, COUNT(*) AS n "
        "FROM tb GROUP BY batch)",
    ]
    return ("WITH " + ",\n".join(ctes) +
            "\nSELECT ROUND(AVG(l), 6) AS test_loss, CAST(SUM(c) AS BIGINT) AS correct, "
            "CAST(SUM(n) AS BIGINT) AS total, "
            "ROUND(100.0 * CAST(SUM(c) AS DOUBLE) / CAST(SUM(n) AS DOUBLE), 6) AS accuracy FROM tbm")


def centroid_ctes(where: str = "TRUE") -> str:
    """CTEs ``xl``, ``cen`` (class means fitted on rows matching ``where``), ``bias``."""
    return (VEC_LONG + ",\n"
            f"cen AS (SELECT label AS k, j, AVG(v) AS mu FROM xl WHERE {where} "
            "GROUP BY label, j),\n"
            "bias AS (SELECT k, -0.5 * SUM(mu * mu) AS b FROM cen GROUP BY k)")


def scores_ctes(fit_where: str = "TRUE", score_where: str = "TRUE") -> str:
    """Adds ``sc(vec_id, label, k, z)``, ``mx``, ``ce(vec_id, label, loss, pred)``."""
    return (centroid_ctes(fit_where) + ",\n"
            "sc AS (SELECT x.vec_id, x.label, c.k, SUM(x.v * c.mu) + MAX(bb.b) AS z "
            f"FROM xl x JOIN cen c ON x.j = c.j JOIN bias bb ON bb.k = c.k WHERE {score_where} "
            "GROUP BY x.vec_id, x.label, c.k),\n"
            "mx AS (SELECT vec_id, MAX(z) AS m FROM sc GROUP BY vec_id),\n"
            "ce AS (SELECT s.vec_id, s.label, "
            "LN(SUM(EXP(s.z - m.m))) - (MAX(CASE WHEN s.k = s.label THEN s.z END) - MAX(m.m)) AS loss, "
            "MIN(CASE WHEN s.z = m.m THEN s.k END) AS pred "
            "FROM sc s JOIN mx m ON s.vec_id = m.vec_id GROUP BY s.vec_id, s.label)")


def positive_zero(sql: str) -> str:
    """Wrap every ``ROUND(...)`` as ``(ROUND(...) + 0.0)``.

    DuckDB keeps the sign of a value that rounds to zero (``-0.0``) while
    Spark's ``round`` returns ``0.0``; adding ``0.0`` gives ``+0.0`` in IEEE
    arithmetic, so both engines print and hash the same value.
    """
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("ROUND")
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(f"{sql[i:j]}({sql[j:k + 1]} + 0.0)")
        i = k + 1


def crop_ctes(src: str = "xl", out: str = "cr", epoch: int = 0, side: int = 8,
              pad: int = 4) -> tuple[str, ...]:
    """Zero-filled window of ``src(vec_id, j, v)`` at the repeatable offsets."""
    span, last = 2 * pad + 1, side - 1
    return (
        f"{out}_o AS (SELECT vec_id, (vec_id * 7 + {epoch}) % {span} - {pad} AS dx, "
        f"(vec_id * 5 + {epoch}) % {span} - {pad} AS dy FROM embeddings)",
        f"{out}_t AS (SELECT x.vec_id, x.j, x.j // {side} + o.dy AS r, x.j % {side} + o.dx AS c "
        f"FROM {src} x JOIN {out}_o o ON x.vec_id = o.vec_id)",
        f"{out} AS (SELECT t.vec_id, t.j, COALESCE(s.v, 0.0) AS v FROM {out}_t t LEFT JOIN {src} s "
        f"ON s.vec_id = t.vec_id AND t.r BETWEEN 0 AND {last} AND t.c BETWEEN 0 AND {last} "
        f"AND s.j = t.r * {side} + t.c)",
    )


def flip_cte(src: str = "xl", out: str = "fl", epoch: int = 0, side: int = 8) -> str:
    """Mirrored grid rows of ``src`` where ``(vec_id + epoch) % 2 = 1``."""
    last = side - 1
    return (f"{out} AS (SELECT x.vec_id, x.j, s.v FROM {src} x JOIN {src} s ON s.vec_id = x.vec_id "
            f"AND s.j = CASE WHEN (x.vec_id + {epoch}) % 2 = 1 THEN (x.j // {side}) * {side} + "
            f"({last} - x.j % {side}) ELSE x.j END)")


def transform_ctes(mean, std, epoch: int = 0, side: int = 8, pad: int = 4) -> tuple[str, ...]:
    """CTEs ``cr`` (crop), ``fl`` (flip), ``tr`` (normalised ``fl``: training
    features) and ``te`` (normalised ``xl``: test features), long form."""
    m = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in mean)
    s = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in std)
    c = len(mean)
    norm = (f"(v - list_extract([{m}], (j % {c}) + 1)) / list_extract([{s}], (j % {c}) + 1)")
    return (
        *crop_ctes("xl", "cr", epoch, side, pad),
        flip_cte("cr", "fl", epoch, side),
        f"tr AS (SELECT vec_id, j, {norm} AS v FROM fl)",
        f"te AS (SELECT vec_id, j, {norm} AS v FROM xl)",
    )
