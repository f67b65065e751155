"""The registered queries as plain SQL over the input tables.

Written for checking only: straightforward SQL (window ranks, naive refits per
penalty), sharing nothing with the Spark side but names.
"""

from __future__ import annotations

KEY = "order_id, line_no, item_id, supplier_id"
COLUMNS = (
    "user_id item_id rating ts order_id line_no supplier_id title genres".split()
)
EPOCH = "CAST(epoch(l_shipdate) AS BIGINT)"
GENRES = "concat(p_type, '|', replace(p_name, ' ', '|'))"


def _ratings(rater: str) -> list[str]:
    orders = "JOIN orders ON l_orderkey = o_orderkey" if rater == "customer" else ""
    user = "o_custkey" if rater == "customer" else "l_orderkey"
    return [
        f"""ratings AS (
            SELECT {user} AS user_id, l_partkey AS item_id,
                   CAST(CEIL(l_quantity / 5) AS DOUBLE) / 2 AS rating,
                   {EPOCH} AS ts, l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
                   l_suppkey AS supplier_id, p_name AS title, {GENRES} AS genres
            FROM lineitem {orders} LEFT JOIN part ON l_partkey = p_partkey)"""
    ]


# The constants of the public 64-bit xxHash.
PRIME_1 = 11400714785074694791
PRIME_2 = 14029467366897019727
PRIME_3 = 1609587929392839161
PRIME_4 = 9650029242287828579
PRIME_5 = 2870177450012600261
SPARK_SEED = 42


def _row_hash(seed: int, key: str) -> str:
    """Spark's ``xxhash64`` over longs, in arithmetic modulo 2^64."""
    mask = f"{2**64 - 1}::UHUGEINT"

    def times(x: str, c: int) -> str:
        return f"(({x} * {c}::UHUGEINT) & {mask})"

    def plus(x: str, c: int) -> str:
        return f"(({x} + {c}::UHUGEINT) & {mask})"

    def rotated(x: str, bits: int) -> str:
        return f"((({x} * {2**64 + 1}::UHUGEINT) >> {64 - bits}) & {mask})"

    def folded(x: str, bits: int) -> str:
        return f"list_transform([{x}], lambda v: xor(v, v >> {bits}))[1]"

    word = times(rotated(times("l", PRIME_2), 31), PRIME_1)
    mixed = f"xor({plus('h', PRIME_5 + 8)}, {word})"
    mixed = plus(times(rotated(mixed, 27), PRIME_1), PRIME_4)
    mixed = times(folded(mixed, 33), PRIME_2)
    mixed = folded(times(folded(mixed, 29), PRIME_3), 32)
    words = ", ".join(f"CAST({c} AS UHUGEINT)" for c in [str(seed), *key.split(", ")])
    return f"list_reduce([{SPARK_SEED}::UHUGEINT, {words}], lambda h, l: {mixed})"


def _sample(
    name: str, source: str, p: float, seed: int, outcome="rating", key=KEY
) -> list[str]:
    """name = source with a flag on exactly ceil(p * n) rows per quartile bin."""
    return [
        f"""{name}_q AS (
            SELECT quantile_cont({outcome}, 0.25e0) AS q1,
                   quantile_cont({outcome}, 0.50e0) AS q2,
                   quantile_cont({outcome}, 0.75e0) AS q3,
                   min({outcome}) AS q0, max({outcome}) AS q4
            FROM {source})""",
        f"""{name}_bin AS (
            SELECT s.*,
                   CAST({outcome} > q1 AND q1 > q0 AND q1 < q4 AS INT)
                 + CAST({outcome} > q2 AND q2 > q0 AND q2 < q4 AS INT)
                 + CAST({outcome} > q3 AND q3 > q0 AND q3 < q4 AS INT) AS bin
            FROM {source} s CROSS JOIN {name}_q)""",
        f"""{name} AS MATERIALIZED (
            SELECT * EXCLUDE (bin), row_number() OVER (
                       PARTITION BY bin
                       ORDER BY {_row_hash(seed, key)})
                   <= ceil(count(*) OVER (PARTITION BY bin) * {p}e0) AS in_sample
            FROM {name}_bin)""",
    ]


def _kept(sampled: str) -> str:
    """in_sample and neither key is in sampled rows only."""
    return f"""in_sample
        AND item_id IN (SELECT item_id FROM {sampled} WHERE NOT in_sample)
        AND user_id IN (SELECT user_id FROM {sampled} WHERE NOT in_sample)"""


def _holdout(rater: str = "customer") -> list[str]:
    return [
        *_ratings(rater),
        *_sample("marked", "ratings", 0.1, 1),
        f"""holdout AS MATERIALIZED (
            SELECT * EXCLUDE (in_sample), in_sample AS sampled,
                   CASE WHEN {_kept('marked')} THEN 'test' ELSE 'train' END AS part
            FROM marked)""",
        "development AS (SELECT * EXCLUDE (part, sampled) FROM holdout WHERE part = 'train')",
        "validation AS (SELECT * EXCLUDE (part, sampled) FROM holdout"
        " WHERE part = 'test')",
    ]


def _train_test(source: str, seed: int, train="train", test="test") -> list[str]:
    name = f"{train}_marked"
    return [
        *_sample(name, source, 0.2, seed),
        f"{train} AS MATERIALIZED (SELECT * FROM {name} WHERE NOT in_sample)",
        f"{test} AS MATERIALIZED (SELECT * FROM {name} WHERE {_kept(name)})",
    ]


def _dev() -> list[str]:
    return [
        *_holdout(),
        *_sample("dev_marked", "development", 0.1, 10),
        "dev AS (SELECT * EXCLUDE (in_sample) FROM dev_marked WHERE in_sample)",
    ]


def _split(rater: str = "customer") -> list[str]:
    return [*_holdout(rater), *_train_test("development", 20)]


def _effects(tag: str, source: str, lams: tuple) -> list[str]:
    """mu{tag}, bi{tag}, bu{tag}, bg{tag}; a penalty is a number or a query."""
    li, lu, lg = lams
    return [
        f"mu{tag} AS MATERIALIZED (SELECT avg(rating) AS mu FROM {source})",
        f"""bi{tag} AS MATERIALIZED (
            SELECT item_id, count(*) AS n, sum(rating - mu) / (count(*) + {li}) AS bi
            FROM {source} CROSS JOIN mu{tag} GROUP BY item_id)""",
        f"""bu{tag} AS MATERIALIZED (
            SELECT user_id, count(*) AS n,
                   sum(rating - mu - bi) / (count(*) + {lu}) AS bu
            FROM {source} LEFT JOIN bi{tag} USING (item_id) CROSS JOIN mu{tag}
            GROUP BY user_id)""",
        f"""bg{tag} AS MATERIALIZED (
            SELECT genres, count(*) AS n,
                   sum(rating - mu - bi - bu) / (count(*) + {lg}) AS bg
            FROM {source} LEFT JOIN bi{tag} USING (item_id)
                 LEFT JOIN bu{tag} USING (user_id) CROSS JOIN mu{tag}
            GROUP BY genres)""",
    ]


def _rated(tag: str, target: str) -> str:
    return f"""{target} t LEFT JOIN bi{tag} USING (item_id)
        LEFT JOIN bu{tag} USING (user_id) LEFT JOIN bg{tag} USING (genres)
        CROSS JOIN mu{tag}"""


def _rmse(estimate: str) -> str:
    return f"sqrt(avg(power(rating - ({estimate}), 2)))"


PLAIN = ("0e0", "0e0", "0e0")
SHRUNK = ("2.2e0", "5.3e0", "1.7e0")
ESTIMATES = ("mu", "mu + bi", "mu + bi + bu", "mu + bi + bu + bg")
# name, depth, tag, as in the ladder
MODELS = (
    ("0 mean", 0, "_p"),
    ("1 item", 1, "_p"),
    ("2 item+user", 2, "_p"),
    ("3 item+user+genre", 3, "_p"),
    ("4 shrunk item", 1, "_s"),
    ("5 shrunk item+user", 2, "_s"),
    ("6 shrunk item+user+genre", 3, "_s"),
)


def _model(name: str, depth: int, tag: str, digits: int, target="test") -> str:
    return f"""SELECT '{name}' AS model,
               round({_rmse(ESTIMATES[depth])}, {digits}) AS rmse
        FROM {_rated(tag, target)}"""


def _both(rater: str = "customer") -> list[str]:
    return [
        *_split(rater),
        *_effects("_p", "train", PLAIN),
        *_effects("_s", "train", SHRUNK),
    ]


def _with(ctes: list[str], select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


def _ladder(rater: str, digits: int) -> tuple[list[str], str]:
    ctes = [*_both(rater), *_effects("_f", "development", SHRUNK)]
    rows = [_model(*m, digits) for m in MODELS]
    rows.append(_model("final on holdout", 3, "_f", digits, "validation"))
    return ctes, " UNION ALL ".join(rows)


def _effect_sql(table: str, tag: str, alias: str, key: str) -> str:
    lams = PLAIN if tag == "_p" else SHRUNK
    return _with(
        [*_split(), *_effects(tag, "train", lams)],
        f"SELECT {key}, n, round({alias}, 6) AS {alias} FROM {table}{tag}",
    )


def _histogram(table: str, column: str) -> str:
    return _with(
        [
            *_split(),
            *_effects("_p", "train", PLAIN),
            f"""span AS (SELECT min({column}) AS lo,
                    (max({column}) - min({column})) / 19 AS w FROM {table}_p)""",
            f"""binned AS (
                SELECT CAST(ceil(({column} - (lo - w / 2)) / w) - 1 AS BIGINT) AS bin,
                       count(*) AS n
                FROM {table}_p CROSS JOIN span GROUP BY 1)""",
        ],
        """SELECT r.bin, round(lo - w / 2 + (r.bin + 0.5e0) * w, 6) AS center,
                  coalesce(n, 0) AS n
           FROM (SELECT range AS bin FROM range(20)) r CROSS JOIN span
                LEFT JOIN binned USING (bin)""",
    )


def _grid(first: float, points: int) -> str:
    return (
        f"(SELECT range AS grid_id, round({first}e0 + range * 0.1e0, 10) AS lam"
        f" FROM range({points}))"
    )


def _curves(li: str, lu: str) -> list[str]:
    """Naive refits: one group mean per key and grid row, scored row by row."""
    return [
        "mu AS MATERIALIZED (SELECT avg(rating) AS mu FROM train)",
        f"""curve_i AS MATERIALIZED (
            WITH b AS (
                SELECT grid_id, lam, item_id,
                       sum(rating - mu) / (count(*) + lam) AS bi
                FROM train CROSS JOIN mu CROSS JOIN {_grid(2.0, 11)}
                GROUP BY grid_id, lam, item_id)
            SELECT grid_id, lam AS lam_item, {_rmse('mu + bi')} AS rmse
            FROM test JOIN b USING (item_id) CROSS JOIN mu GROUP BY grid_id, lam)""",
        f"""best_i AS MATERIALIZED (SELECT {li} AS lam_item)""",
        """bi AS MATERIALIZED (
            SELECT item_id, sum(rating - mu) / (count(*) + lam_item) AS bi
            FROM train CROSS JOIN mu CROSS JOIN best_i GROUP BY item_id, lam_item)""",
        f"""curve_u AS MATERIALIZED (
            WITH b AS (
                SELECT grid_id, lam, user_id,
                       sum(rating - mu - bi) / (count(*) + lam) AS bu
                FROM train JOIN bi USING (item_id) CROSS JOIN mu
                     CROSS JOIN {_grid(4.5, 16)}
                GROUP BY grid_id, lam, user_id)
            SELECT grid_id, lam_item, lam AS lam_user,
                   {_rmse('mu + bi + bu')} AS rmse
            FROM test JOIN bi USING (item_id) JOIN b USING (user_id)
                 CROSS JOIN mu CROSS JOIN best_i GROUP BY grid_id, lam, lam_item)""",
        f"""best_u AS MATERIALIZED (SELECT {lu} AS lam_user)""",
        """bu AS MATERIALIZED (
            SELECT user_id, sum(rating - mu - bi) / (count(*) + lam_user) AS bu
            FROM train JOIN bi USING (item_id) CROSS JOIN mu CROSS JOIN best_u
            GROUP BY user_id, lam_user)""",
        f"""curve_g AS MATERIALIZED (
            WITH b AS (
                SELECT grid_id, lam, genres,
                       sum(rating - mu - bi - bu) / (count(*) + lam) AS bg
                FROM train JOIN bi USING (item_id) JOIN bu USING (user_id)
                     CROSS JOIN mu CROSS JOIN {_grid(1.6, 4)}
                GROUP BY grid_id, lam, genres)
            SELECT grid_id, lam_item, lam_user, lam AS lam_genre,
                   {_rmse('mu + bi + bu + bg')} AS rmse
            FROM test JOIN bi USING (item_id) JOIN bu USING (user_id)
                 JOIN b USING (genres)
                 CROSS JOIN mu CROSS JOIN best_i CROSS JOIN best_u GROUP BY grid_id, lam, lam_item, lam_user)""",
    ]


def _tuning(select: str, rater="customer", li="2.2e0", lu="5.3e0") -> str:
    return _with([*_split(rater), *_curves(li, lu)], select)


def _curve(table: str, lams: str) -> str:
    return _tuning(f"SELECT grid_id, {lams}, round(rmse, 6) AS rmse FROM {table}")


def _best(rater: str) -> str:
    best = "(SELECT {0} FROM {1} ORDER BY rmse, grid_id LIMIT 1)"
    return _tuning(
        """SELECT round(rmse, 6) AS rmse, grid_id, lam_item, lam_user, lam_genre
           FROM curve_g ORDER BY curve_g.rmse, grid_id LIMIT 1""",
        rater,
        best.format("lam_item", "curve_i"),
        best.format("lam_user", "curve_u"),
    )


JOINT_CURVE = """SELECT grid_id, lam_item, lam_user, lam_genre, round(rmse, 6) AS rmse
    FROM joint"""


def _joint(select: str, rater: str = "customer") -> str:
    """Naive refits of every combination of a 3 x 4 x 3 grid, scored row by row."""

    def axis(first: float, step: float, points: int, name: str, stride: int) -> str:
        return (
            f"(SELECT range * {stride} AS {name}_at, round({first}e0 + range * {step}e0, 10)"
            f" AS lam_{name} FROM range({points}))"
        )

    ctes = [
        "mu AS MATERIALIZED (SELECT avg(rating) AS mu FROM train)",
        f"""bi AS MATERIALIZED (
            SELECT item_at, lam_item, item_id, sum(rating - mu) / (count(*) + lam_item) AS bi
            FROM train CROSS JOIN mu CROSS JOIN {axis(2.0, 0.5, 3, "item", 1)}
            GROUP BY item_at, lam_item, item_id)""",
        f"""bu AS MATERIALIZED (
            SELECT item_at, user_at, lam_user, user_id,
                   sum(rating - mu - bi) / (count(*) + lam_user) AS bu
            FROM train JOIN bi USING (item_id) CROSS JOIN mu
                 CROSS JOIN {axis(4.5, 0.5, 4, "user", 3)}
            GROUP BY item_at, user_at, lam_user, user_id)""",
        f"""bg AS MATERIALIZED (
            SELECT item_at, user_at, genre_at, lam_genre, genres,
                   sum(rating - mu - bi - bu) / (count(*) + lam_genre) AS bg
            FROM train JOIN bi USING (item_id) JOIN bu USING (item_at, user_id)
                 CROSS JOIN mu CROSS JOIN {axis(1.6, 0.1, 3, "genre", 12)}
            GROUP BY item_at, user_at, genre_at, lam_genre, genres)""",
        f"""joint AS MATERIALIZED (
            SELECT item_at + user_at + genre_at AS grid_id, lam_item, lam_user, lam_genre,
                   {_rmse('mu + bi + bu + bg')} AS rmse
            FROM test JOIN bi USING (item_id) JOIN bu USING (item_at, user_id)
                 JOIN bg USING (item_at, user_at, genres) CROSS JOIN mu
            GROUP BY item_at, user_at, genre_at, lam_item, lam_user, lam_genre)""",
    ]
    return _with([*_split(rater), *ctes], select)


def _missing(name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing,"
        f" '{name}' AS table_name FROM {name}"
        for c in COLUMNS
    )


def _count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def oracle_sql() -> dict[str, str]:
    ratings, development, split = _ratings("customer"), _holdout(), _split()
    dev_split = [*_dev(), *_train_test("dev", 20)]
    seen = """validation
        WHERE item_id IN (SELECT item_id FROM train)
          AND user_id IN (SELECT user_id FROM train)"""
    columns = ", ".join(COLUMNS)
    windows = [
        *split,
        "mu AS (SELECT avg(rating) AS mu FROM train)",
        """wi AS (SELECT t.*, mu, avg(rating - mu) OVER (PARTITION BY item_id) AS bi
               FROM train t CROSS JOIN mu)""",
        """wu AS (SELECT *, avg(rating - mu - bi) OVER (PARTITION BY user_id) AS bu
               FROM wi)""",
    ]
    final = [*development, *_effects("_f", "development", SHRUNK)]
    out = {
        "scan_ratings_text": _with(
            ratings, "SELECT user_id, item_id, rating, ts FROM ratings"
        ),
        "accepted_lines": _with(
            ratings, "SELECT user_id, item_id, rating, ts FROM ratings"
        ),
        "rejected_lines": """
            SELECT concat_ws('::', p_partkey, p_name, p_type) AS line, '3 fields' AS reason
            FROM part
            UNION ALL
            SELECT concat_ws('::', p_partkey, p_size, p_name, p_brand),
                   'unreadable: rating, ts' FROM part""",
        "order_total_runs": """
            WITH binned AS (
                SELECT CAST(ceil(o_totalprice / 0.01e0 - 0.5e0) AS BIGINT) AS slot,
                       count(*) AS n
                FROM orders GROUP BY 1),
            ranked AS (
                SELECT *, lag(slot) OVER (ORDER BY slot) AS before, min(slot) OVER () AS lo
                FROM binned)
            SELECT slot - lo AS bin, round(slot * 0.01e0, 6) AS center, n,
                   CAST(1 AS BIGINT) AS bins FROM ranked
            UNION ALL
            SELECT before + 1 - lo, round((before + 1) * 0.01e0, 6), CAST(0 AS BIGINT),
                   slot - before - 1 FROM ranked WHERE slot - before > 1""",
        "scan_items_text": """SELECT p_partkey AS item_id, p_name AS title,
            concat(p_type, '::', p_brand) AS genres FROM part""",
        "left_join_items": _with(
            ratings,
            f"""SELECT {columns.replace(", title, genres", "")},
                       (SELECT p_name FROM part WHERE p_partkey = item_id) AS title,
                       (SELECT p_type || '|' || replace(p_name, ' ', '|')
                        FROM part WHERE p_partkey = item_id) AS genres
                FROM ratings""",
        ),
        "bound_ratings": _with(ratings, f"SELECT {columns} FROM ratings"),
        "preview_rows": _with(
            development,
            f"""SELECT {columns} FROM development
                ORDER BY user_id, item_id, order_id, line_no, supplier_id LIMIT 6""",
        ),
        "table_dims": _with(
            development,
            """SELECT count(*) AS n_rows,
                      CAST(max(len(json_keys(to_json(development)))) AS BIGINT)
                          AS n_columns
               FROM development""",
        ),
        "rating_equals_counts": _with(
            development,
            f"""SELECT {_count_if('rating = 0')} AS n_zero,
                       {_count_if('rating = 3')} AS n_three FROM development""",
        ),
        "genre_match_counts": _with(
            development,
            f"""SELECT {_count_if("regexp_matches(genres, 'ring')")} AS n_ring,
                       {_count_if("regexp_matches(genres, 'bolt')")} AS n_bolt,
                       {_count_if("regexp_matches(genres, 'ECONOMY')")} AS n_economy,
                       {_count_if("regexp_matches(genres, 'LARGE')")} AS n_large
                FROM development""",
        ),
        "whole_rating_share": _with(
            development,
            """SELECT round(avg(CAST(round_even(rating, 0) = rating AS DOUBLE)), 6)
                   AS whole_share FROM development""",
        ),
        "distinct_counts": _with(
            development,
            """SELECT count(DISTINCT item_id) AS n_items,
                      count(DISTINCT user_id) AS n_users FROM development""",
        ),
        "null_counts": _with(development, f"{_missing('development')} UNION ALL {_missing('validation')}"),
        "dataset_summary": _with(
            development,
            """SELECT count(DISTINCT user_id) AS n_users,
                      count(DISTINCT item_id) AS n_items,
                      min(rating) AS min_rating, max(rating) AS max_rating
               FROM (SELECT * FROM development UNION ALL SELECT * FROM validation)""",
        ),
        "top_items_by_count": _with(
            development,
            """SELECT item_id, title, count(*) AS n FROM development GROUP BY item_id, title
               ORDER BY n DESC, item_id, title LIMIT 10""",
        ),
        "top_rating_values": _with(
            development,
            """SELECT rating, count(*) AS n FROM development GROUP BY rating
               ORDER BY n DESC, rating LIMIT 5""",
        ),
        "rating_frequency": _with(
            development, "SELECT rating, count(*) AS n FROM development GROUP BY rating"
        ),
        "distinct_genres": _with(development, "SELECT DISTINCT genres FROM development"),
        "rating_histogram": _with(
            [
                *development,
                """binned AS (
                    SELECT CAST(ceil(rating / 0.5e0 - 0.5e0) AS BIGINT) AS slot,
                           count(*) AS n
                    FROM development GROUP BY 1)""",
                "span AS (SELECT min(slot) AS lo, max(slot) AS hi FROM binned)",
            ],
            """SELECT slot - lo AS bin, round(slot * 0.5e0, 6) AS center,
                      coalesce(n, 0) AS n
               FROM (SELECT unnest(range(lo, hi + 1)) AS slot, lo FROM span)
                    LEFT JOIN binned USING (slot)""",
        ),
        "event_value_histogram": _with(
            [
                """binned AS (
                    SELECT CAST(ceil(value / 0.1e0 - 0.5e0) AS BIGINT) AS slot,
                           count(*) AS n
                    FROM events GROUP BY 1)""",
                "span AS (SELECT min(slot) AS lo, max(slot) AS hi FROM binned)",
            ],
            """SELECT slot - lo AS bin, round(slot * 0.1e0, 6) AS center,
                      coalesce(n, 0) AS n
               FROM (SELECT unnest(range(lo, hi + 1)) AS slot, lo FROM span)
                    LEFT JOIN binned USING (slot)""",
        ),
        "item_effect_histogram": _histogram("bi", "bi"),
        "user_effect_histogram": _histogram("bu", "bu"),
        "genre_effect_histogram": _histogram("bg", "bg"),
        "sampled_ratings": _with(
            [*ratings, *_sample("marked", "ratings", 0.1, 1)],
            f"SELECT {KEY}, rating FROM marked WHERE in_sample",
        ),
        "sampled_events": _with(
            _sample("marked", "events", 0.1, 10, "value", "event_id"),
            "SELECT event_id, user_id, value, in_sample FROM marked",
        ),
        "dev_subset": _with(_dev(), f"SELECT {KEY}, user_id, rating FROM dev"),
        "holdout_split": _with(development, f"SELECT {KEY}, part FROM holdout"),
        "holdout_split_basket": _with(
            _holdout("basket"), f"SELECT {KEY}, part FROM holdout"
        ),
        "holdout_given_back": _with(
            _holdout("basket"),
            f"SELECT {KEY}, rating FROM holdout WHERE sampled AND part = 'train'",
        ),
        "sampled_not_in_holdout": _with(
            _holdout("basket"),
            f"""SELECT {KEY}, rating FROM
                (SELECT * EXCLUDE (in_sample) FROM marked WHERE in_sample) s
                ANTI JOIN validation v ON {' AND '.join(
                    f's.{c} IS NOT DISTINCT FROM v.{c}' for c in COLUMNS)}""",
        ),
        "train_test_split": _with(
            split,
            f"""SELECT {KEY}, 'train' AS part FROM train
                UNION ALL SELECT {KEY}, 'test' AS part FROM test""",
        ),
        "train_test_split_basket": _with(
            _split("basket"),
            f"""SELECT {KEY}, 'train' AS part FROM train
                UNION ALL SELECT {KEY}, 'test' AS part FROM test""",
        ),
        "cold_start_filter": _with(dev_split, f"SELECT {KEY}, user_id FROM {seen}"),
        "mean_rating": _with(split, "SELECT round(avg(rating), 6) AS mu FROM train"),
        "item_effect_window": _with(windows, f"SELECT {KEY}, round(bi, 6) AS bi FROM wi"),
        "user_effect_window": _with(
            windows, f"SELECT {KEY}, round(bi, 6) AS bi, round(bu, 6) AS bu FROM wu"
        ),
        "predictions_final": _with(
            final,
            f"""SELECT {KEY}, rating, round(mu + bi + bu + bg, 6) AS r_hat
                FROM {_rated('_f', 'validation')}""",
        ),
        "tune_lambda_item": _curve("curve_i", "lam_item"),
        "tune_lambda_user": _curve("curve_u", "lam_item, lam_user"),
        "tune_lambda_genre": _curve("curve_g", "lam_item, lam_user, lam_genre"),
        "best_lambda_item": _tuning(
            """SELECT round(rmse, 6) AS rmse, grid_id, lam_item FROM curve_i
               ORDER BY curve_i.rmse, grid_id LIMIT 1"""
        ),
        "best_lambdas": _best("customer"),
        "best_lambdas_basket": _best("basket"),
        "tune_lambdas_jointly": _joint(JOINT_CURVE),
        "tune_lambdas_jointly_basket": _joint(JOINT_CURVE, "basket"),
        "best_lambdas_jointly": _joint(
            """SELECT round(rmse, 6) AS rmse, grid_id, lam_item, lam_user, lam_genre
               FROM joint ORDER BY joint.rmse, grid_id LIMIT 1"""
        ),
        "final_holdout_rmse": _with(
            final, _model("final on holdout", 3, "_f", 6, "validation")
        ),
        "final_holdout_rmse_subset_filter": _with(
            [
                *dev_split,
                f"known AS (SELECT * FROM {seen})",
                *_effects("_f", "development", SHRUNK),
            ],
            _model("final on holdout", 3, "_f", 6, "known"),
        ),
        "final_test_rmse": _with(
            [*development, *_train_test("development", 50), *_effects("_s", "train", SHRUNK)],
            _model("final on test", 3, "_s", 6),
        ),
    }
    for table, alias, key in (
        ("bi", "bi", "item_id"),
        ("bu", "bu", "user_id"),
        ("bg", "bg", "genres"),
    ):
        name = {"bi": "item", "bu": "user", "bg": "genre"}[table]
        out[f"{name}_effect_mean"] = _effect_sql(table, "_p", alias, key)
        out[f"{name}_effect_shrunk"] = _effect_sql(table, "_s", alias, key)
    out["user_effect_aligned"] = out["user_effect_shrunk"]
    out["genre_effect_aligned"] = out["genre_effect_shrunk"]
    out["model_ladder_aligned_basket"] = _with(
        _both("basket"), " UNION ALL ".join(_model(*model, 5) for model in MODELS)
    )
    for i, model in enumerate(MODELS):
        out[f"rmse_model{i}"] = _with(_both(), _model(*model, 6))
    out["model_ladder"] = _with(*_ladder("customer", 5))
    out["model_ladder_basket"] = _with(*_ladder("basket", 5))
    ctes, ladder = _ladder("customer", 15)
    out["improvement_over_naive"] = _with(
        [*ctes, f"ladder AS MATERIALIZED ({ladder})"],
        """SELECT model, round(rmse, 6) AS rmse, round(1 - rmse / (
               SELECT rmse FROM ladder WHERE model = '0 mean'), 6) AS improvement
           FROM ladder""",
    )
    return out
