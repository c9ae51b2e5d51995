"""Equivalent SQL of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from tamiz.catalogue.queries import (
    EMBEDDING_CLASSES,
    EVENT_TYPES,
    FIVE_TYPES,
    LINE_FEATURES,
    MORE_TYPES,
    ORDER_STATES,
    PART_FEATURES,
    PART_TYPES,
    SEGMENTS,
)

TRAIN_BOUND = f"{round(0.8 * 16**8):08x}"


def hashed(key: str, seed: int = 42) -> str:
    return f"md5('{seed}|' || {key})"


def random_part(key: str) -> str:
    return f"CASE WHEN substr({hashed(key)}, 1, 8) < '{TRAIN_BOUND}' THEN 'train' ELSE 'dev' END"


def class_id(column: str, mapping: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {column} {cases} END AS BIGINT)"


def label_of(column: str, mapping: dict[str, int]) -> str:
    cases = " ".join(f"WHEN {v} THEN '{k}'" for k, v in mapping.items())
    return f"CASE {column} {cases} END"


def stratified(source: str, key: str, target: str, out: str) -> str:
    """CTEs up to ``out``: ``source`` with a column split."""
    return f"""
    {out}_k AS MATERIALIZED (SELECT {target} AS c, count(*) AS k FROM {source} GROUP BY 1),
    {out}_t AS (SELECT sum(k)::BIGINT AS n, (sum(k)::BIGINT + 4) // 5 AS t FROM {out}_k),
    {out}_b AS (SELECT c, k * t // n AS base, t, row_number() OVER (ORDER BY k * t % n DESC, c) AS place,
                       sum(k * t // n) OVER () AS given FROM {out}_k, {out}_t),
    {out}_q AS (SELECT c, base + CASE WHEN place <= t - given THEN 1 ELSE 0 END AS quota FROM {out}_b),
    {out} AS MATERIALIZED (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY {target} ORDER BY {hashed(key)}) <= quota
                             THEN 'dev' ELSE 'train' END AS split
                FROM {source} s JOIN {out}_q ON s.{target} = {out}_q.c)"""


EMBEDDINGS = "emb AS (SELECT vec_id, embedding::DOUBLE[] AS v, label::BIGINT AS label FROM embeddings)"
EMBEDDING_SPLIT = f"{EMBEDDINGS}, {stratified('emb', 'vec_id', 'label', 's')}"
EMBEDDING_DISTANCE = {
    1: "list_sum(list_transform(list_zip(q.v, t.v), lambda x: abs(x[1] - x[2])))",
    2: "list_distance(q.v, t.v)",
}

PARTS_GAPS = """gaps AS (SELECT p_partkey, p_type,
        CASE WHEN p_brand <> 'Brand#7' THEN p_brand END AS p_brand,
        CASE WHEN p_brand <> 'Brand#7' THEN p_size::DOUBLE END AS p_size,
        CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS p_retailprice FROM part)"""
PARTS = f"""parts AS (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice,
        {class_id('p_type', PART_TYPES)} AS label FROM part)"""
PART_SPLIT = f"{PARTS}, {stratified('parts', 'p_partkey', 'label', 's')}"


def point_distance(columns, p: int) -> str:
    if p == 1:
        return " + ".join(f"abs(q.{c} - t.{c})" for c in columns)
    return "sqrt(" + " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in columns) + ")"


def significant(x: str) -> str:
    """``x`` at 12 significant digits."""
    scale = f"pow(10e0, 11 - floor(log10(abs({x}))))"
    return f"CASE WHEN abs({x}) > 1e-280 AND abs({x}) < 1e280 THEN round_even({x} * {scale}, 0) / {scale} ELSE {x} END"


def neighbours(queries: str, train: str, key: str, distance: str, k: int, out: str = "nb") -> str:
    """CTE (qid, qlabel, tid, tlabel, d, r)."""
    return f"""
    {out} AS MATERIALIZED (SELECT * FROM (
        SELECT qid, qlabel, tid, tlabel, d, row_number() OVER (PARTITION BY qid ORDER BY d, tid) AS r FROM (
            SELECT * REPLACE ({significant('d')} AS d) FROM (
                SELECT q.{key} AS qid, q.label AS qlabel, t.{key} AS tid, t.label AS tlabel, {distance} AS d
                FROM {queries} q CROSS JOIN {train} t))) WHERE r <= {k})"""


def vote(source: str, k: int, weights: str, out: str) -> str:
    """CTE (qid, qlabel, tlabel, w)."""
    w = "1e0"
    if weights == "distance":
        w = "CASE WHEN min(d) OVER (PARTITION BY qid) = 0 THEN (d = 0)::INT::DOUBLE ELSE 1e0 / nullif(d, 0) END"
    return f"""
    {out} AS (SELECT qid, qlabel, tlabel, sum(w) AS w FROM (
        SELECT qid, qlabel, tlabel, {w} AS w FROM {source} WHERE r <= {k}) GROUP BY 1, 2, 3)"""


def winners(source: str, out: str, extra: str = "") -> str:
    """CTE (qid, label, predicted_value)."""
    return f"""
    {out} AS (SELECT qid, qlabel AS label, tlabel AS predicted_value{extra}
        FROM (SELECT *, sum(w) OVER (PARTITION BY qid) AS total FROM {source})
        QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(w / total, 9) DESC, tlabel) = 1)"""


DEV, TRAIN = "(SELECT * FROM s WHERE split = 'dev')", "(SELECT * FROM s WHERE split = 'train')"


def embedding_vote(p: int, weights: str, k: int = 5) -> str:
    return f"""{EMBEDDING_SPLIT}, {neighbours(DEV, TRAIN, 'vec_id', EMBEDDING_DISTANCE[p], k)},
    {vote('nb', k, weights, 'v')}, {winners('v', 'w')}"""


def part_vote(columns, p: int, weights: str, k: int = 5) -> str:
    return f"""WITH {PART_SPLIT}, {neighbours(DEV, TRAIN, 'p_partkey', point_distance(columns, p), k)},
    {vote('nb', k, weights, 'v')}, {winners('v', 'w')}
    SELECT qid AS p_partkey, label, predicted_value FROM w"""


def report(confusion: str, by: str = "") -> str:
    """CTEs c_, t_ and the final select over confusion counts (label, prediction, n)."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    f1 = "CASE WHEN support + claimed > 0 THEN 2e0 * hits / (support + claimed) ELSE 0 END"
    return f"""
    sides AS (SELECT {keys}label AS class, n AS support, 0 AS claimed,
                     CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM {confusion}
              UNION ALL SELECT {keys}prediction, 0, n, 0 FROM {confusion}),
    sums AS (SELECT {keys}class, sum(support)::DOUBLE AS support, sum(claimed)::DOUBLE AS claimed,
                    sum(hits)::DOUBLE AS hits FROM sides GROUP BY {keys}class),
    per AS (SELECT *, CASE WHEN claimed > 0 THEN hits / claimed ELSE 0 END AS precision,
                   CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, {f1} AS f1_score FROM sums),
    tot AS (SELECT {keys}sum(support) AS n, sum(hits) / sum(support) AS acc,
                   avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
                   sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
                   sum(f1_score * support) / sum(support) AS wf FROM per {group}),
    rep AS (SELECT {keys}class::VARCHAR AS "row", precision, recall, f1_score, support FROM per
            UNION ALL SELECT {keys}'accuracy', acc, acc, acc, acc FROM tot
            UNION ALL SELECT {keys}'macro avg', mp, mr, mf, n FROM tot
            UNION ALL SELECT {keys}'weighted avg', wp, wr, wf, n FROM tot)"""


def report_select(by: str = "", extra: str = "") -> str:
    keys = f"{by}, " if by else ""
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in ("precision", "recall", "f1_score", "support"))
    return f'SELECT {keys}"row", {rounded}{extra} FROM rep'


def sweep(dev: str, train: str, key: str, distances: dict[int, str]) -> str:
    """CTEs up to conf (model, label, prediction, n) of the default KNN grid."""
    parts, all_models = [], []
    for p in (1, 2):
        parts.append(neighbours(dev, train, key, distances[p], 5, f"nb{p}"))
    for w in ("uniform", "distance"):
        for k in (1, 3, 5):
            for p in (1, 2):
                name = f"{w[0]}{k}{p}"
                parts.append(vote(f"nb{p}", k, w, f"v{name}"))
                parts.append(winners(f"v{name}", f"w{name}"))
                all_models.append(f"SELECT 'KNN-k:{k}-p:{p}-w:{w}' AS model, {len(all_models)} AS place, * FROM w{name}")
    union = " UNION ALL ".join(all_models)
    return f"""{', '.join(parts)}, pred AS MATERIALIZED ({union}),
    conf AS (SELECT model, label, predicted_value AS prediction, count(*) AS n FROM pred
             WHERE label IS NOT NULL GROUP BY 1, 2, 3)"""


BEST = """SELECT model AS name, round(value, 6) AS value FROM (
    SELECT model, f1_score AS value, (SELECT min(place) FROM pred p WHERE p.model = rep.model) AS place
    FROM rep WHERE "row" = 'weighted avg') WHERE value > 0 ORDER BY round(value, 12) DESC, place LIMIT 1"""

EMBEDDING_SWEEP = f"{EMBEDDING_SPLIT}, {sweep(DEV, TRAIN, 'vec_id', EMBEDDING_DISTANCE)}, {report('conf', 'model')}"
EMBEDDING_CONFUSION = f"""{embedding_vote(2, 'distance')},
    conf AS (SELECT label, predicted_value AS prediction, count(*) AS n FROM w GROUP BY 1, 2)"""


def probabilities(classes: dict[str, int]) -> str:
    return ", ".join(
        f"round(coalesce(sum(w) FILTER (tlabel = {c}), 0) / sum(w), 6) AS \"probability_of_value_{name}\""
        for name, c in classes.items()
    )


def auc(scores: str) -> str:
    """Hand and Till over CTE ``scores`` (label, of, score), by ranks of each pair of classes."""
    return f"""
    counts AS MATERIALIZED (SELECT "of", label, score, count(*) AS n FROM {scores} GROUP BY 1, 2, 3),
    sizes AS (SELECT label, sum(n) AS size FROM counts GROUP BY "of", label HAVING "of" = (SELECT min("of") FROM counts)),
    pairs AS (SELECT a.label AS i, b.label AS j FROM sizes a, sizes b WHERE a.label <> b.label),
    ordered AS (SELECT i, j, label, n,
                  sum(CASE WHEN label = j THEN n ELSE 0 END) OVER (PARTITION BY i, j ORDER BY score RANGE UNBOUNDED PRECEDING) AS upto,
                  sum(CASE WHEN label = j THEN n ELSE 0 END) OVER (PARTITION BY i, j, score) AS tied
                FROM pairs JOIN counts ON "of" = i AND label IN (i, j)),
    a AS (SELECT i, j, sum(CASE WHEN label = i THEN n * (upto - tied / 2e0) ELSE 0 END) AS won FROM ordered GROUP BY 1, 2)
    SELECT round(avg(won / (x.size::DOUBLE * y.size)), 6) AS auc
    FROM a JOIN sizes x ON x.label = i JOIN sizes y ON y.label = j"""


def tree(rows: str, depth: int, min_leaf: int, out: str, classes=tuple(PART_TYPES.values())) -> str:
    """CTEs {out}0 .. {out}<depth>: each training row's node per level; {out}cut<l>: the splits of level l."""
    n = [f"n{c}" for c in classes]
    counts = ", ".join(f"count(*) FILTER (label = {c}) AS n{c}" for c in classes)
    parts = [
        f"{out}wt AS MATERIALIZED (SELECT label, (SELECT count(*) FROM {rows})::DOUBLE / "
        f"((SELECT count(DISTINCT label) FROM {rows}) * count(*)) AS w FROM {rows} GROUP BY 1)",
        f"{out}0 AS MATERIALIZED (SELECT *, 0::BIGINT AS node FROM {rows})",
    ]
    w = {c: f"(SELECT w FROM {out}wt WHERE label = {c})" for c in classes}

    def impurity(side):
        total = " + ".join(f"{s} * {w[c]}" for s, c in zip(side, classes))
        squares = " + ".join(f"({s} * {w[c]}) * ({s} * {w[c]})" for s, c in zip(side, classes))
        return f"(({total}) - ({squares}) / nullif({total}, 0))"

    below, above = [f"b{c}" for c in classes], [f"(t{c} - b{c})" for c in classes]
    whole = " + ".join(f"t{c} * {w[c]}" for c in classes)
    for level in range(depth):
        src, cut = f"{out}{level}", f"{out}cut{level}"
        running = ", ".join(
            f"coalesce(sum({x}) OVER (PARTITION BY node, feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b{c}, "
            f"sum({x}) OVER (PARTITION BY node, feature) AS t{c}"
            for x, c in zip(n, classes)
        )
        parts.append(f"""
        {cut} AS MATERIALIZED (SELECT node, feature, threshold FROM (
          SELECT node, feature, CASE WHEN prev + (v - prev) / 2 < v THEN prev + (v - prev) / 2 ELSE prev END AS threshold,
                 round(({impurity(below)} + {impurity(above)}) / ({whole}), 9) AS score
          FROM (SELECT node, feature, v, lag(v) OVER (PARTITION BY node, feature ORDER BY v) AS prev, {running}
                FROM (SELECT node, feature, v, {counts} FROM (
                        SELECT node, 0 AS feature, p_size AS v, label FROM {src}
                        UNION ALL SELECT node, 1, p_retailprice, label FROM {src}) GROUP BY 1, 2, 3))
          WHERE prev IS NOT NULL AND {' + '.join(below)} >= {min_leaf} AND {' + '.join(above)} >= {min_leaf}
            AND {' + '.join(f'(t{c} > 0)::INT' for c in classes)} > 1)
          QUALIFY row_number() OVER (PARTITION BY node ORDER BY score, feature, threshold) = 1),
        {descend(src, cut, f'{out}{level + 1}')}""")
    return ", ".join(parts)


def descend(src: str, cut: str, out: str) -> str:
    side = "CASE WHEN (CASE feature WHEN 0 THEN p_size ELSE p_retailprice END) <= threshold THEN 1 ELSE 2 END"
    return f"""{out} AS MATERIALIZED (SELECT x.* EXCLUDE (node),
        CASE WHEN threshold IS NULL THEN x.node ELSE 2 * x.node + {side} END AS node
        FROM {src} x LEFT JOIN {cut} USING (node))"""


def leaves(prefix: str, depth: int) -> str:
    """CTE {prefix}leaf<depth> (node, label, share) of the tree cut at depth."""
    return f"""{prefix}leaf{depth} AS MATERIALIZED (SELECT node, label, sum(w) / sum(sum(w)) OVER (PARTITION BY node) AS share
        FROM {prefix}{depth} JOIN {prefix}wt USING (label) GROUP BY 1, 2),
    {prefix}win{depth} AS MATERIALIZED (SELECT node, label AS predicted_value FROM {prefix}leaf{depth}
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(share, 9) DESC, label) = 1)"""


def follow(rows: str, prefix: str, depth: int, out: str) -> str:
    """CTEs: ``rows`` sent down the tree of ``prefix``."""
    parts = [f"{out}0 AS (SELECT *, 0::BIGINT AS node FROM {rows})"]
    parts += [descend(f"{out}{i}", f"{prefix}cut{i}", f"{out}{i + 1}") for i in range(depth)]
    return ", ".join(parts)


def tree_sweep(depths, leaf_sizes, start: str = PART_SPLIT, source: str = "s", mapping=PART_TYPES) -> str:
    """The whole query: ``start`` gives CTE ``source`` (p_partkey, p_size, p_retailprice, label, split)."""
    return f"{tree_sweep_report(depths, leaf_sizes, start, source, mapping)} {report_select('model')}"


def tree_sweep_report(depths, leaf_sizes, start: str, source: str, mapping) -> str:
    classes = tuple(mapping.values())
    top = max(depths)
    rows = "(SELECT p_partkey, p_size, p_retailprice, label FROM {} WHERE split = '{}')"
    parts = [start, f"tr AS MATERIALIZED {rows.format(source, 'train')}", f"dv AS MATERIALIZED {rows.format(source, 'dev')}"]
    models = []
    for m in leaf_sizes:
        parts += [tree("tr", top, m, f"m{m}_", classes), follow("dv", f"m{m}_", top, f"d{m}_")]
        parts += [leaves(f"m{m}_", d) for d in depths]
    for d in depths:
        for m in leaf_sizes:
            models.append(
                f"SELECT 'DecisionTree-z:{d}-l:{m}' AS model, label, predicted_value AS prediction "
                f"FROM d{m}_{d} JOIN m{m}_win{d} USING (node)"
            )
    union = " UNION ALL ".join(models)
    conf = f"conf AS MATERIALIZED (SELECT model, label, prediction, count(*) AS n FROM ({union}) GROUP BY 1, 2, 3)"
    return f"WITH {', '.join(parts)}, {conf}, {report('conf', 'model')}"


def fill(columns, source: str, where: str = "split = 'train'", statistic: str = "avg") -> str:
    return ", ".join(f"coalesce({c}, (SELECT {statistic}({c}) FROM {source} WHERE {where})) AS {c}" for c in columns)


def scale(columns, source: str, where: str = "split = 'train'") -> str:
    return ", ".join(
        f"({c} - (SELECT avg({c}) FROM {source} WHERE {where})) / (SELECT stddev_samp({c}) FROM {source} WHERE {where}) AS {c}"
        for c in columns
    )


def prepared_job(per_split: bool, gaps: str, mapping=PART_TYPES, rescaled: bool = True) -> str:
    """CTEs to u: the parts with gaps, split, filled, rescaled and undersampled."""
    p = ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY split)) AS {c}" for c in PART_FEATURES)
    q = ", ".join(
        f"({c} - avg({c}) OVER (PARTITION BY split)) / stddev_samp({c}) OVER (PARTITION BY split) AS {c}"
        for c in PART_FEATURES
    )
    filled = p if per_split else fill(PART_FEATURES, "s")
    scaled = q if per_split else scale(PART_FEATURES, "f")
    scaled = scaled if rescaled else ", ".join(PART_FEATURES)
    cut = "TRUE" if per_split else "split = 'train'"
    return f"""{gaps}, g AS (SELECT p_partkey, p_size, p_retailprice, {class_id('p_type', mapping)} AS label FROM gaps),
    {stratified('g', 'p_partkey', 'label', 's')},
    f AS MATERIALIZED (SELECT p_partkey, label, split, {filled} FROM s),
    z AS MATERIALIZED (SELECT p_partkey, label, split, {scaled} FROM f),
    least AS (SELECT split, min(k) AS k FROM (SELECT split, label, count(*) AS k FROM z GROUP BY 1, 2) GROUP BY 1),
    u AS MATERIALIZED (SELECT z.* FROM z JOIN least USING (split)
        QUALIFY NOT ({cut}) OR row_number() OVER (PARTITION BY split, label ORDER BY {hashed('p_partkey', 43)}) <= any_value(k) OVER (PARTITION BY split))"""


def training_job(per_split: bool) -> str:
    """CTEs to the report of the whole KNN job on the parts with gaps."""
    return f"""{prepared_job(per_split, PARTS_GAPS)},
    {sweep("(SELECT * FROM u WHERE split = 'dev')", "(SELECT * FROM u WHERE split = 'train')", 'p_partkey',
           {p: point_distance(PART_FEATURES, p) for p in (1, 2)})},
    {report('conf', 'model')} {report_select('model')}"""


def scoring(mapping: dict[str, int], k: int, weights: str, p: int, refill: bool) -> str:
    """CTEs up to v (votes) and w (winners) of the dev parts, scored by a model of the train parts."""
    known = "split = 'train' AND label IS NOT NULL"
    dev_fill = "split = 'dev'" if refill else known
    return f"""{PARTS_GAPS}, g AS MATERIALIZED (SELECT p_partkey, p_size, p_retailprice, {class_id('p_type', mapping)} AS label,
        {random_part('p_partkey')} AS split FROM gaps),
    f AS MATERIALIZED (SELECT p_partkey, label, split, {fill(PART_FEATURES, 'g', known)} FROM g WHERE {known}
        UNION ALL SELECT p_partkey, label, split, {fill(PART_FEATURES, 'g', dev_fill)} FROM g WHERE split = 'dev'),
    z AS MATERIALIZED (SELECT p_partkey, label, split, {scale(PART_FEATURES, 'f')} FROM f),
    {neighbours("(SELECT * FROM z WHERE split = 'dev')", "(SELECT * FROM z WHERE split = 'train')", 'p_partkey',
                point_distance(PART_FEATURES, p), k)},
    {vote('nb', k, weights, 'v')}, {winners('v', 'w')},
    zz AS (SELECT * FROM z WHERE split = 'dev')"""


def one_pass(expressions: dict[str, str]) -> str:
    return ", ".join(f"round({e}, 6) AS {c}" for c, e in expressions.items())


EVENT_GAPS = "CASE WHEN event_type <> 'error' THEN value END"
BALANCE_GAPS = "CASE WHEN c_acctbal >= 0 THEN c_acctbal END"


def rescaled_lines(method: str) -> str:
    def expression(c):
        if method == "MINMAX":
            return f"({c} - (SELECT min({c}) FROM t)) / ((SELECT max({c}) FROM t) - (SELECT min({c}) FROM t))"
        return f"({c} - (SELECT avg({c}) FROM t)) / (SELECT stddev_samp({c}) FROM t)"

    columns = one_pass({c: expression(c) for c in LINE_FEATURES})
    return f"""WITH s AS (SELECT *, {random_part('l_orderkey')} AS split FROM lineitem),
    t AS (SELECT * FROM s WHERE split = 'train')
    SELECT l_orderkey, l_linenumber, {columns}, split FROM s"""


def zscore_by_split(c: str) -> str:
    return f"({c} - avg({c}) OVER w) / stddev_samp({c}) OVER w"


SPLIT_PARTS = f"SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice, {random_part('p_partkey')} AS split FROM part"


def most_frequent(column: str, source: str, where: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {where} AND {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


def statistics_row(c: str) -> str:
    return f"""SELECT '{c}' AS feature, count(*) AS n_rows, count({c}) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
        round(median({c}), 6) AS median, round({most_frequent(c, 'lineitem', 'TRUE')}, 6) AS mode FROM lineitem"""


def factor(column: str, source: str, key: str) -> str:
    return (
        f"coalesce((SELECT code FROM (SELECT {column} AS v, row_number() OVER (ORDER BY min({key})) - 1 AS code "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY 1) d WHERE d.v = x.{column}), -1)::BIGINT AS {column}"
    )


TREE2 = f"{PARTS}, {tree('parts', 2, 1, 't')}, {leaves('t', 2)}"
TREE5 = f"""{PART_SPLIT}, tr AS MATERIALIZED {TRAIN}, dv AS MATERIALIZED {DEV}, {tree('tr', 5, 1, 't')},
    {follow('dv', 't', 5, 'd')}, {leaves('t', 5)}"""

MODEL_GOODNESS = f"""WITH {PART_SPLIT}, {neighbours(DEV, TRAIN, 'p_partkey', point_distance(PART_FEATURES, 2), 5)},
    {vote('nb', 5, 'uniform', 'v')}, {winners('v', 'w')}, tr AS MATERIALIZED {TRAIN}, dv AS MATERIALIZED {DEV},
    {tree('tr', 2, 1, 't')}, {follow('dv', 't', 2, 'd')}, {leaves('t', 2)},
    conf AS (SELECT model, label, prediction, count(*) AS n FROM (
        SELECT 'KNN-k:5-p:2-w:uniform' AS model, label, predicted_value AS prediction FROM w
        UNION ALL SELECT 'DecisionTree-z:2-l:1', label, predicted_value FROM d2 JOIN twin2 USING (node)) GROUP BY 1, 2, 3),
    {report('conf', 'model')} SELECT model, round(f1_score, 6) AS value FROM rep WHERE "row" = 'macro avg'"""

WEIGHTED_ROWS = """labelled AS (SELECT quality::BIGINT AS label, n_chars::DOUBLE AS p_size, doc_id::DOUBLE AS p_retailprice
        FROM labels JOIN documents USING (doc_id))"""

# Fewer prices than bins, where binned splits are exact.
COARSE = "(floor(p_retailprice)::BIGINT % 37)::DOUBLE"
COARSE_SPLIT = PART_SPLIT.replace("p_size::DOUBLE AS p_size, p_retailprice,", f"p_size::DOUBLE AS p_size, {COARSE} AS p_retailprice,")
ORDER_ROWS = """gaps AS (SELECT o_orderkey AS p_partkey, o_orderstatus AS p_type, (o_custkey % 6)::DOUBLE AS p_size,
    (floor(o_totalprice)::BIGINT % 5)::DOUBLE AS p_retailprice FROM orders)"""
ORDER_SPLIT = f"""{ORDER_ROWS}, orders_g AS (SELECT p_partkey, p_size, p_retailprice, {class_id('p_type', ORDER_STATES)} AS label FROM gaps),
    {stratified('orders_g', 'p_partkey', 'label', 's')}"""
ORDER_JOB = prepared_job(False, ORDER_ROWS, ORDER_STATES)
DEFAULT_TREES = (3, 6, 9), (1, 2)


def one_tree(start: str, depth: int, mapping=PART_TYPES) -> str:
    """CTEs: a tree of the train rows (t...) and the dev rows sent down it (d...)."""
    classes = tuple(mapping.values())
    return f"""{start}, tr AS MATERIALIZED {TRAIN}, dv AS MATERIALIZED {DEV}, {tree('tr', depth, 1, 't', classes)},
    {follow('dv', 't', depth, 'd')}, {leaves('t', depth)}"""


BEST_TREE = """SELECT model AS name, round(value, 6) AS value FROM (
    SELECT model, f1_score AS value, list_position([{names}], model) AS place
    FROM rep WHERE "row" = 'macro avg') WHERE value > 0 ORDER BY round(value, 12) DESC, place LIMIT 1""".format(
    names=", ".join(f"'DecisionTree-z:{d}-l:{m}'" for d in DEFAULT_TREES[0] for m in DEFAULT_TREES[1])
)

TINY_SPLIT = f"""{PARTS}, tiny AS (SELECT p_partkey, label, p_size * 1e-12 AS p_size, p_retailprice * 1e-12 AS p_retailprice FROM parts),
    {stratified('tiny', 'p_partkey', 'label', 's')}"""

EVENT_SPLIT = f"""s AS MATERIALIZED (SELECT event_id, epoch_us(ts) / 1e6 AS ts, user_id::DOUBLE AS user_id,
    {class_id('event_type', EVENT_TYPES)} AS label, {random_part('event_id')} AS split FROM events)"""

CATEGORICAL = (*PART_FEATURES, "p_brand")


def categorical_job() -> str:
    """The KNN job with brands: gaps are a category, categories are numbered by first appearance."""
    known = "split = 'train'"
    return f"""{PARTS_GAPS}, b AS (SELECT * REPLACE (coalesce(p_brand, 'NULL_CATEGORY') AS p_brand) FROM gaps),
    code AS (SELECT p_brand AS v, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS c FROM b GROUP BY 1),
    g AS (SELECT p_partkey, p_size, p_retailprice, c::DOUBLE AS p_brand, {class_id('p_type', PART_TYPES)} AS label
          FROM b JOIN code ON v = p_brand),
    {stratified('g', 'p_partkey', 'label', 's')},
    f AS MATERIALIZED (SELECT p_partkey, label, split, p_brand, {fill(PART_FEATURES, 's')} FROM s),
    z AS MATERIALIZED (SELECT p_partkey, label, split, {scale(CATEGORICAL, 'f')} FROM f),
    least AS (SELECT min(k) AS k FROM (SELECT label, count(*) AS k FROM z WHERE {known} GROUP BY 1)),
    u AS MATERIALIZED (SELECT z.* FROM z, least
        QUALIFY split = 'dev' OR row_number() OVER (PARTITION BY split, label ORDER BY {hashed('p_partkey', 43)}) <= k),
    {sweep("(SELECT * FROM u WHERE split = 'dev')", "(SELECT * FROM u WHERE split = 'train')", 'p_partkey',
           {p: point_distance(CATEGORICAL, p) for p in (1, 2)})},
    {report('conf', 'model')} {report_select('model')}"""


def refilled_dropped() -> str:
    known = "split = 'train' AND label IS NOT NULL"
    return f"""WITH {PARTS_GAPS}, g AS MATERIALIZED (SELECT p_partkey, p_size,
        CASE WHEN p_partkey % 5 > 0 THEN p_retailprice END AS p_retailprice, {class_id('p_type', PART_TYPES)} AS label,
        {random_part('p_partkey')} AS split FROM gaps WHERE p_size IS NOT NULL),
    f AS MATERIALIZED (SELECT p_partkey, label, split, p_size, {fill(['p_retailprice'], 'g', known)} FROM g WHERE {known}
        UNION ALL SELECT p_partkey, label, split, p_size, {fill(['p_retailprice'], 'g', "split = 'dev'")} FROM g WHERE split = 'dev'),
    z AS MATERIALIZED (SELECT p_partkey, label, split, {scale(PART_FEATURES, 'f')} FROM f),
    {neighbours("(SELECT * FROM z WHERE split = 'dev')", "(SELECT * FROM z WHERE split = 'train')", 'p_partkey',
                point_distance(PART_FEATURES, 1), 3)},
    {vote('nb', 3, 'distance', 'v')}, {winners('v', 'w')} SELECT qid AS p_partkey, predicted_value FROM w"""


def vote_of_distance(start: str, key: str, columns) -> str:
    return f"""WITH {start}, {neighbours(DEV, TRAIN, key, point_distance(columns, 2), 5)},
    {vote('nb', 5, 'distance', 'v')}, {winners('v', 'w')} SELECT qid AS {key}, label, predicted_value FROM w"""


def many_statistics() -> str:
    columns = ", ".join(f"l_quantity + {i} * l_tax AS f{i}" for i in range(12))
    rows = " UNION ALL ".join(statistics_row(f"f{i}").replace("lineitem", "m").replace(", 6)", ", 3)") for i in range(12))
    return f"WITH m AS MATERIALIZED (SELECT {columns} FROM lineitem) {rows}"


ORACLES: dict[str, str] = {
    "csv_codes_and_long_ids": """SELECT p_partkey + 1234567890000000000 AS id,
        p_size || CASE WHEN p_size % 2 = 0 THEN 'D' ELSE 'F' END AS code FROM part""",
    "report_csv_again": f"""WITH conf AS (SELECT l_returnflag AS model, (l_linestatus = 'O')::BIGINT AS label,
            (l_discount > 5e-2)::BIGINT AS prediction, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
        {report('conf', 'model')} {report_select('model')}""",
    "impute_mean_integers": """WITH g AS (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#7' THEN p_size::DOUBLE END AS p_size FROM part)
        SELECT p_partkey, round(coalesce(p_size, (SELECT avg(p_size) FROM g)), 6) AS p_size FROM g""",
    "fit_statistics_many": many_statistics(),
    "knn_unscaled_epoch": vote_of_distance(EVENT_SPLIT, "event_id", ("ts", "user_id")),
    "knn_small_scale": vote_of_distance(TINY_SPLIT, "p_partkey", PART_FEATURES),
    "tree_exact_sweep_default": tree_sweep(*DEFAULT_TREES),
    "tree_sweep_report_orders": tree_sweep(*DEFAULT_TREES, ORDER_SPLIT, "s", ORDER_STATES),
    "tree_binned_sweep_orders": tree_sweep(*DEFAULT_TREES, ORDER_SPLIT, "s", ORDER_STATES),
    "tree_mllib_predict_orders": f"WITH {one_tree(ORDER_SPLIT, 5, ORDER_STATES)} SELECT p_partkey, label, predicted_value FROM d5 JOIN twin5 USING (node)",
    "tree_probabilities_absent_class": f"""WITH {TREE2} SELECT p_partkey, any_value(x.label) AS label,
        any_value(predicted_value) AS predicted_value,
        {', '.join(f'round(coalesce(sum(share) FILTER (l.label = {c}), 0), 6) AS "probability_of_value_{n}"' for n, c in MORE_TYPES.items())}
        FROM t2 x JOIN twin2 USING (node) JOIN tleaf2 l USING (node) GROUP BY p_partkey""",
    "tree_auc": f"""WITH {one_tree(PART_SPLIT, 3)}, scores AS (
        SELECT x.label, c."of", {significant('coalesce(l.share, 0e0)')} AS score
        FROM d3 x CROSS JOIN (SELECT unnest({sorted(PART_TYPES.values())}) AS "of") c
        LEFT JOIN tleaf3 l ON l.node = x.node AND l.label = c."of"), {auc('scores')}""",
    "tree_scored_stored": f"""WITH {one_tree(COARSE_SPLIT, 3)} SELECT model, p_partkey, CASE WHEN known THEN label END AS target, predicted_value
        FROM d3 JOIN twin3 USING (node), (SELECT unnest(['exact', 'mllib']) AS model), (SELECT unnest([true, false]) AS known)""",
    "training_job_best_tree_orders": f"{tree_sweep_report(*DEFAULT_TREES, ORDER_JOB, 'u', ORDER_STATES)} {BEST_TREE}",
    "training_job_tree_report_orders": tree_sweep(*DEFAULT_TREES, ORDER_JOB, "u", ORDER_STATES),
    "training_job_tree_report_raw": tree_sweep(*DEFAULT_TREES, prepared_job(False, PARTS_GAPS, rescaled=False), "u"),
    "tree_binned_probabilities": f"""WITH {PARTS}, {tree('parts', 4, 1, 't')}, {leaves('t', 4)}
        SELECT p_partkey, any_value(x.label) AS label, any_value(predicted_value) AS predicted_value,
        {', '.join(f'round(coalesce(sum(share) FILTER (l.label = {c}), 0), 6) AS "probability_of_value_{n}"' for n, c in PART_TYPES.items())}
        FROM t4 x JOIN twin4 USING (node) JOIN tleaf4 l USING (node) GROUP BY p_partkey""",
    "training_job_categorical": f"WITH {categorical_job()}",
    "score_refilled_dropped": refilled_dropped(),
    "scan_limit": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000""",
    "preview_rows": "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 5",
    "select_except_rename": """SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS balance, c_mktsegment,
        round(greatest(-c_acctbal, 0e0), 6) AS debt FROM customer""",
    "standardise_types": """SELECT event_id, round(epoch_us(ts) / 1e6, 6) AS ts, user_id::DOUBLE AS user_id,
        event_type, round(value, 6) AS value FROM events""",
    "label_map_drop_unknown": f"""SELECT c_custkey, c_mktsegment, round(c_acctbal, 6) AS c_acctbal,
        {class_id('c_mktsegment', SEGMENTS)} AS target FROM customer
        WHERE c_mktsegment IN ({', '.join(f"'{s}'" for s in SEGMENTS)})""",
    "inverse_label_map": f"""SELECT c_custkey, {class_id('c_mktsegment', SEGMENTS)} AS target, c_mktsegment AS segment
        FROM customer WHERE c_mktsegment IN ({', '.join(f"'{s}'" for s in SEGMENTS)})""",
    "class_distribution": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1",
    "table_shape": "SELECT count(*) AS n_rows, 5::BIGINT AS n_columns FROM documents",
    "csv_round_trip": f"""SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey,
        round({BALANCE_GAPS}, 6) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_declared_types": """SELECT p_partkey, p_type,
        CASE WHEN p_brand <> 'Brand#7' THEN p_size::DOUBLE END AS p_size FROM part""",
    "report_sink": f"""WITH conf AS (SELECT l_returnflag AS model, (l_linestatus = 'O')::BIGINT AS label,
            (l_discount > 5e-2)::BIGINT AS prediction, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
        {report('conf', 'model')} {report_select('model', ", 'rule' AS algorithm")}""",
    "drop_missing_rows": "SELECT event_id, event_type, round(value, 6) AS value FROM events WHERE event_type <> 'error'",
    "impute_mean": f"""WITH s AS (SELECT event_id, event_type, {EVENT_GAPS} AS value, {random_part('event_id')} AS split FROM events)
        SELECT event_id, event_type, round(coalesce(value, (SELECT avg(value) FROM s WHERE split = 'train')), 6) AS value,
        split FROM s""",
    "impute_median": f"""WITH {PARTS_GAPS}, s AS (SELECT *, {random_part('p_partkey')} AS split FROM gaps),
        f AS (SELECT p_partkey, split, {fill(PART_FEATURES, 's', statistic='median')} FROM s)
        SELECT p_partkey, round(p_size, 6) AS p_size, round(p_retailprice, 6) AS p_retailprice, split FROM f""",
    "impute_mode": f"""WITH {PARTS_GAPS}, s AS (SELECT *, {random_part('p_partkey')} AS split FROM gaps)
        SELECT p_partkey, split, round(coalesce(p_size, {most_frequent('p_size', 's', "split = 'train'")}), 6) AS p_size,
        coalesce(p_brand, {most_frequent('p_brand', 's', "split = 'train'")}) AS p_brand FROM s""",
    "impute_constant": f"SELECT event_id, event_type, round(coalesce({EVENT_GAPS}, -1e0), 6) AS value FROM events",
    "impute_create_category": """SELECT event_id,
        CASE WHEN value < 30 THEN event_type ELSE 'NULL_CATEGORY' END AS event_type FROM events""",
    "impute_per_split": f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
            {random_part('o_orderkey')} AS split FROM orders)
        SELECT o_orderkey, split, round(coalesce(o_totalprice, avg(o_totalprice) OVER (PARTITION BY split)), 6) AS o_totalprice
        FROM s""",
    "impute_self": f"""SELECT c_custkey,
        round(coalesce({BALANCE_GAPS}, (SELECT avg({BALANCE_GAPS}) FROM customer)), 6) AS c_acctbal FROM customer""",
    "impute_then_rescale": f"""WITH {PARTS_GAPS}, s AS (SELECT *, {random_part('p_partkey')} AS split FROM gaps),
        f AS (SELECT p_partkey, split, {fill(['p_size'], 's', statistic='median')}, {fill(['p_retailprice'], 's')} FROM s),
        t AS (SELECT * FROM f WHERE split = 'train')
        SELECT p_partkey, split,
          round((p_size - (SELECT min(p_size) FROM t)) / ((SELECT max(p_size) FROM t) - (SELECT min(p_size) FROM t)), 6) AS p_size,
          round((p_retailprice - (SELECT avg(p_retailprice) FROM t)) / (SELECT stddev_samp(p_retailprice) FROM t), 6) AS p_retailprice
        FROM f""",
    "rescale_minmax": rescaled_lines("MINMAX"),
    "rescale_avgstd": rescaled_lines("AVGSTD"),
    "rescale_per_split": f"""WITH s AS ({SPLIT_PARTS}) SELECT p_partkey, split,
        round((p_size - min(p_size) OVER w) / (max(p_size) OVER w - min(p_size) OVER w), 6) AS p_size,
        round({zscore_by_split('p_retailprice')}, 6) AS p_retailprice FROM s WINDOW w AS (PARTITION BY split)""",
    "drop_zero_variance": f"""WITH s AS ({SPLIT_PARTS}) SELECT p_partkey, split,
        {one_pass({c: zscore_by_split(c) for c in PART_FEATURES})} FROM s WINDOW w AS (PARTITION BY split)""",
    "fit_statistics_wide": " UNION ALL ".join(statistics_row(c) for c in LINE_FEATURES),
    "factorize": f"""SELECT o_orderkey, {factor('o_orderpriority', 'orders', 'o_orderkey')},
        {factor('o_orderstatus', 'orders', 'o_orderkey')} FROM orders x""",
    "factorize_many_values": f"""WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name, c_nationkey FROM customer)
        SELECT c_custkey, {factor('c_name', 'g', 'c_custkey')}, {factor('c_nationkey', 'g', 'c_custkey')} FROM g x""",
    "split_stratified": f"""WITH l AS (SELECT doc_id, quality::BIGINT AS quality FROM labels),
        {stratified('l', 'doc_id', 'quality', 's')} SELECT doc_id, quality, split FROM s""",
    "split_stratified_classes": f"WITH {EMBEDDING_SPLIT} SELECT vec_id, label, split FROM s",
    "split_random": f"SELECT o_orderkey, {random_part('o_orderkey')} AS split FROM orders",
    "undersample_not_minority": f"""WITH k AS (SELECT min(n) AS quota FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment)),
        r AS (SELECT c_custkey, c_mktsegment,
              row_number() OVER (PARTITION BY c_mktsegment ORDER BY {hashed('c_custkey')}) AS r FROM customer)
        SELECT c_custkey, c_mktsegment FROM r, k WHERE r <= quota""",
    "undersample_ratio": f"""WITH k AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1),
        q AS (SELECT toxic, CASE WHEN n = (SELECT max(n) FROM k) THEN floor((SELECT min(n) FROM k) / 0.5) ELSE n END AS quota FROM k),
        r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {hashed('doc_id')}) AS r FROM labels)
        SELECT doc_id, toxic::BIGINT AS toxic FROM r JOIN q USING (toxic) WHERE r <= quota""",
    "class_weights_balanced": """SELECT quality::BIGINT AS quality, n,
        round(sum(n) OVER () / (count(*) OVER () * n::DOUBLE), 6) AS weight
        FROM (SELECT quality, count(*) AS n FROM labels GROUP BY 1)""",
    "row_weights_balanced": """WITH w AS (SELECT toxic, sum(count(*)) OVER () / (count(*) OVER () * count(*)::DOUBLE) AS weight
        FROM labels GROUP BY 1) SELECT doc_id, toxic::BIGINT AS toxic, round(weight, 6) AS weight FROM labels JOIN w USING (toxic)""",
    "knn_uniform_l2": f"WITH {embedding_vote(2, 'uniform')} SELECT qid AS vec_id, label, predicted_value FROM w",
    "knn_uniform_l1": f"WITH {embedding_vote(1, 'uniform')} SELECT qid AS vec_id, label, predicted_value FROM w",
    "knn_partitioned_uniform_l2": f"WITH {embedding_vote(2, 'uniform')} SELECT qid AS vec_id, label, predicted_value FROM w",
    "knn_neighbours": f"""WITH {embedding_vote(2, 'uniform')} SELECT qid AS vec_id, r AS rank, tid AS train_id, tlabel AS label,
        round(d, 6) AS distance FROM nb""",
    "knn_distance_l2": part_vote(PART_FEATURES, 2, "distance"),
    "knn_distance_l1": part_vote(PART_FEATURES, 1, "distance"),
    "knn_partitioned_distance_l2": part_vote(PART_FEATURES, 2, "distance"),
    "knn_partitioned_distance_l1": part_vote(PART_FEATURES, 1, "distance"),
    "knn_distance_ties": part_vote(("p_size",), 2, "distance"),
    "knn_partitioned_ties": part_vote(("p_size",), 1, "distance"),
    "knn_probabilities": f"""WITH {embedding_vote(2, 'distance')}, pr AS (SELECT qid,
            {probabilities({str(c): c for c in EMBEDDING_CLASSES})} FROM v GROUP BY qid)
        SELECT qid AS vec_id, label, predicted_value, pr.* EXCLUDE (qid) FROM w JOIN pr USING (qid)""",
    "knn_sweep_report": f"WITH {EMBEDDING_SWEEP} {report_select('model')}",
    "knn_sweep_best": f"WITH {EMBEDDING_SWEEP} {BEST}",
    "confusion_matrix": f"WITH {EMBEDDING_CONFUSION} SELECT label, prediction, n FROM conf",
    "classification_report": f"WITH {EMBEDDING_CONFUSION}, {report('conf')} {report_select()}",
    "multiclass_auc": f"""WITH {embedding_vote(2, 'distance')}, scores AS (
            SELECT label, "of", {significant('x')} AS score FROM (
            SELECT w.label, c."of", coalesce(sum(v.w) FILTER (v.tlabel = c."of"), 0) / sum(v.w) AS x
            FROM w JOIN v ON v.qid = w.qid CROSS JOIN (SELECT unnest({EMBEDDING_CLASSES}) AS "of") c GROUP BY w.qid, 1, 2)),
        {auc('scores')}""",
    "multiclass_auc_rows": f"""WITH l AS (SELECT {class_id('l_returnflag', {'A': 0, 'N': 1, 'R': 2})} AS label,
            l_extendedprice, l_quantity, l_discount FROM lineitem),
        scores AS (SELECT label, 0 AS "of", l_extendedprice AS score FROM l UNION ALL SELECT label, 1, l_quantity FROM l
            UNION ALL SELECT label, 2, l_discount FROM l), {auc('scores')}""",
    "tree_best_split": f"""WITH {WEIGHTED_ROWS}, {tree('labelled', 1, 1, 't', (0, 1))},
        sides AS (SELECT count(*) FILTER (label = 0 AND node = 1) AS left_0, count(*) FILTER (label = 1 AND node = 1) AS left_1
            FROM t1),
        imp AS (SELECT sum(g) / sum(w) AS score FROM (SELECT node, sum(w) AS w, sum(w) - sum(w * w) / sum(w) AS g FROM (
            SELECT node, label, sum(w) AS w FROM t1 JOIN twt USING (label) GROUP BY 1, 2) GROUP BY 1))
        SELECT feature::BIGINT AS feature, round(threshold, 6) AS threshold, round(score, 6) AS score, left_0, left_1
        FROM tcut0, sides, imp""",
    "tree_exact_depth2": f"""WITH {TREE2} SELECT p_partkey, any_value(x.label) AS label, any_value(predicted_value) AS predicted_value,
        {', '.join(f'round(coalesce(sum(share) FILTER (l.label = {c}), 0), 6) AS "probability_of_value_{n}"' for n, c in PART_TYPES.items())}
        FROM t2 x JOIN twin2 USING (node) JOIN tleaf2 l USING (node) GROUP BY p_partkey""",
    "tree_exact_predict": f"WITH {TREE5} SELECT p_partkey, label, predicted_value FROM d5 JOIN twin5 USING (node)",
    "tree_exact_sweep_report": tree_sweep((1, 2), (1, 2)),
    "model_goodness": MODEL_GOODNESS,
    "scored_dataset": f"""WITH {PART_SPLIT}, {neighbours(DEV, TRAIN, 'p_partkey', point_distance(PART_FEATURES, 2), 5)},
        {vote('nb', 5, 'uniform', 'v')}, {winners('v', 'w')}, pr AS (SELECT qid, {probabilities(PART_TYPES)} FROM v GROUP BY qid)
        SELECT p_partkey, x.p_size, round(x.p_retailprice, 6) AS p_retailprice, x.p_type,
          {label_of('predicted_value', PART_TYPES)} AS predicted_type, pr.* EXCLUDE (qid)
        FROM w JOIN pr USING (qid) JOIN part x ON x.p_partkey = qid""",
    "score_unlabelled": f"""WITH {scoring(PART_TYPES, 5, 'uniform', 2, False)},
        pr AS (SELECT qid, {probabilities(PART_TYPES)} FROM v GROUP BY qid)
        SELECT p_partkey, round(p_size, 6) AS p_size, round(p_retailprice, 6) AS p_retailprice, predicted_value, pr.* EXCLUDE (qid)
        FROM zz JOIN w ON w.qid = p_partkey JOIN pr ON pr.qid = p_partkey""",
    "score_labelled": f"""WITH {scoring(FIVE_TYPES, 5, 'uniform', 2, False)}
        SELECT p_partkey, zz.label AS target, predicted_value FROM zz JOIN w ON w.qid = p_partkey""",
    "score_labelled_report": f"""WITH {scoring(FIVE_TYPES, 5, 'uniform', 2, False)},
        conf AS (SELECT label, predicted_value AS prediction, count(*) AS n FROM w WHERE label IS NOT NULL GROUP BY 1, 2),
        {report('conf')} {report_select()}""",
    "score_refilled": f"""WITH {scoring(PART_TYPES, 3, 'distance', 1, True)} SELECT qid AS p_partkey, predicted_value FROM w""",
    "training_job_report": f"WITH {training_job(False)}",
    "training_job_per_split": f"WITH {training_job(True)}",
}
# The same rows found another way.
ORACLES["knn_two_levels_distance_l2"] = ORACLES["knn_distance_l2"]
ORACLES["score_unlabelled_index"] = ORACLES["score_unlabelled"]
ORACLES["fit_statistics_268"] = """WITH cells AS (SELECT i, CASE WHEN (l_orderkey + i) % 11 > 0
        THEN l_quantity * (i % 7 + 1) + l_extendedprice / (i + 1e0) END AS v FROM lineitem, range(268) t(i))
    SELECT 'f' || i AS feature, count(*) AS n_rows, count(v) AS n, round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std,
        round(min(v), 3) AS min, round(max(v), 3) AS max FROM cells GROUP BY i"""
