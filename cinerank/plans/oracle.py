"""Independent SQL formulations of the registered queries (DuckDB dialect).

Each entry is one statement: the fixture views, shared CTEs, then the query.
The texts are written from the operator definitions, not generated from the
Spark plans, so that agreement is evidence of correctness.
"""

from __future__ import annotations

from cinerank.functions.text import english_stop_words, sql_string_list
from cinerank.sources.sql_views import with_ctes


def _fix(col: str) -> str:
    s = col
    for lit, rep in (("None", "null"), ("True", "true"), ("False", "false")):
        s = f"regexp_replace({s}, ':\\s*{lit}\\b', ': {rep}', 'g')"
    return f"replace({s}, '''', '\"')"


def _objs(col: str) -> str:
    fx = _fix(col)
    return (
        f"CASE WHEN json_valid({fx}) AND json_type(({fx})::JSON) = 'ARRAY' "
        f"THEN list_filter(json_extract({fx}, '$[*]'), lambda x: json_type(x) = 'OBJECT') ELSE []::JSON[] END"
    )


def _names(objs: str) -> str:
    return f"list_transform({objs}, lambda o: CASE WHEN json_exists(o, '$.name') THEN json_extract_string(o, '$.name') ELSE '' END)"


def _joined(lst: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda x: coalesce(x, '<null>')), '|')"


STOP = sql_string_list(english_stop_words())
WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"

ITEMS_JOINED = """
SELECT i.id, coalesce(i.title, i.original_title) AS title, i.genres, i.keywords, c.cast_list, c.crew,
       i.production_countries, i.release_date, i.runtime, i.original_language,
       i.popularity, i.vote_average, i.vote_count
FROM raw_items i JOIN raw_credits c ON i.id = c.movie_id
"""

ITEMS_PARSED = f"""
SELECT *,
       {_names('g_objs')} AS genres_list,
       {_names('k_objs')} AS keywords_list,
       ({_names('c_objs')})[1:5] AS cast_names,
       list_transform(list_filter(crew_objs, lambda o: json_extract_string(o, '$.job') = 'Director'),
                      lambda o: json_extract_string(o, '$.name')) AS directors,
       json_extract_string(pc_objs[1], '$.iso_3166_1') AS country_iso,
       year(try_cast(release_date AS DATE)) AS year
FROM (SELECT *, {_objs('genres')} AS g_objs, {_objs('keywords')} AS k_objs, {_objs('cast_list')} AS c_objs,
             {_objs('crew')} AS crew_objs, {_objs('production_countries')} AS pc_objs
      FROM items_joined) s
"""

ITEMS_TAGGED = """
SELECT *,
       array_to_string(list_transform(
           list_filter(list_concat(list_concat(list_concat(list_concat(genres_list, keywords_list), cast_names), directors),
                                   [coalesce(country_iso, '')]),
                       lambda t: t IS NOT NULL AND t <> ''),
           lambda t: replace(lower(t), ' ', '')), ' ') AS tags_raw
FROM items_parsed
"""

RUNTIME_Z = """
SELECT id, (rt - mu) / CASE WHEN sd IS NULL OR sd = 0 THEN 1 ELSE sd END AS runtime_z
FROM (SELECT id, nullif(coalesce(runtime, 0), 0) AS rt FROM items_joined) r,
     (SELECT avg(nullif(coalesce(runtime, 0), 0)) AS mu, stddev_pop(nullif(coalesce(runtime, 0), 0)) AS sd FROM items_joined) st
"""

LANG_ORDER = """
SELECT lang, n, CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS INTEGER) AS lang_idx
FROM (SELECT coalesce(original_language, 'xx') AS lang, count(*) AS n FROM items_joined GROUP BY 1) t
"""

LANG_INDEX = """
SELECT j.id, j.original_language, lo.lang_idx
FROM items_joined j LEFT JOIN lang_order lo ON coalesce(j.original_language, 'xx') = lo.lang
"""

RATINGS_MAPPED = """
SELECT r.userId, CAST(l.tmdbId AS BIGINT) AS movieId, r.rating, r.rated_at
FROM raw_ratings r
JOIN raw_links l ON r.movieId = l.movieId AND l.tmdbId IS NOT NULL
WHERE CAST(l.tmdbId AS BIGINT) IN (SELECT i.id FROM raw_items i JOIN raw_credits c ON i.id = c.movie_id)
"""

USER_SPLIT = """
SELECT userId,
       CASE WHEN rn <= floor(n * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) THEN 'train' ELSE 'valid' END AS split
FROM (SELECT userId,
             row_number() OVER (ORDER BY md5(concat(CAST(userId AS VARCHAR), '_42')), userId) AS rn,
             count(*) OVER () AS n
      FROM (SELECT DISTINCT userId FROM ratings_mapped) u) t
"""

RATINGS_SPLIT = """
SELECT r.userId, r.movieId, r.rating, r.rated_at, s.split
FROM ratings_mapped r JOIN user_split s ON r.userId = s.userId
WHERE r.userId IN (SELECT userId FROM ratings_mapped GROUP BY userId
                   HAVING count(*) FILTER (WHERE rating >= 4) > 0 AND count(*) FILTER (WHERE rating < 4) > 0)
"""

PRUNED = """
SELECT * FROM ratings_mapped
WHERE userId IN (SELECT userId FROM ratings_mapped GROUP BY userId HAVING count(*) >= 5)
  AND movieId IN (SELECT movieId FROM ratings_mapped
                  WHERE userId IN (SELECT userId FROM ratings_mapped GROUP BY userId HAVING count(*) >= 5)
                  GROUP BY movieId HAVING count(*) >= 20)
  AND movieId IN (SELECT id FROM items_joined)
"""

BASE = [
    ("items_joined", ITEMS_JOINED),
    ("items_parsed", ITEMS_PARSED),
    ("items_tagged", ITEMS_TAGGED),
    ("items_rtz", RUNTIME_Z),
    ("lang_order", LANG_ORDER),
    ("items_lang", LANG_INDEX),
    ("ratings_mapped", RATINGS_MAPPED),
    ("user_split", USER_SPLIT),
    ("ratings_split", RATINGS_SPLIT),
    ("pruned", PRUNED),
]


def _q(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_ctes(BASE + (extra or []), body)


def _df_cut_ctes(prefix: str, src: str, key: str, text: str) -> list[tuple[str, str]]:
    return [
        (f"{prefix}_tok", f"SELECT {key}, list_filter(regexp_extract_all(lower(coalesce({text}, '')), '{WORD}'), lambda t: NOT list_contains({STOP}, t)) AS lemmas FROM {src}"),
        (f"{prefix}_df", f"SELECT tok, count(*) AS df FROM (SELECT DISTINCT rid, tok FROM (SELECT row_number() OVER () AS rid, lemmas FROM {prefix}_tok) x, unnest(x.lemmas) AS u(tok)) d GROUP BY tok"),
        (f"{prefix}_drop", f"SELECT coalesce(list(tok), []::VARCHAR[]) AS dropped FROM {prefix}_df WHERE df > 0.5 * (SELECT count(*) FROM {prefix}_tok)"),
        (f"{prefix}_clean", f"SELECT t.{key}, array_to_string(list_filter(t.lemmas, lambda x: NOT list_contains(d.dropped, x)), ' ') AS clean_tags FROM {prefix}_tok t, {prefix}_drop d"),
    ]


ORACLE: dict[str, str] = {}

ORACLE["movie_credit_join"] = _q("SELECT * FROM items_joined")

ORACLE["nested_list_parse"] = _q(f"""
SELECT id, {_joined('genres_list')} AS genres_str, CAST(len(genres_list) AS INTEGER) AS n_genres,
       {_joined('keywords_list')} AS keywords_str, {_joined('cast_names')} AS cast_str,
       CAST(len(cast_names) AS INTEGER) AS n_cast, {_joined('directors')} AS directors_str, country_iso, year
FROM items_parsed
""")

ORACLE["tag_string"] = _q("SELECT id, tags_raw FROM items_tagged")

ORACLE["token_df_cut"] = _q("SELECT doc_id, clean_tags FROM doc_clean", _df_cut_ctes("doc", "documents", "doc_id", "text"))

_LEMMA_CTES = [
    ("lm_tok", f"SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{WORD}'), lambda t: NOT list_contains({STOP}, t)) AS toks FROM documents"),
    ("lm_words", "SELECT DISTINCT unnest(toks) AS token FROM lm_tok"),
    ("lm_dict", "SELECT p.token, s.token AS lemma FROM lm_words p JOIN lm_words s ON s.token = left(p.token, length(p.token) - 1) WHERE length(p.token) >= 4 AND p.token LIKE '%s'"),
    ("lm_at", "SELECT doc_id, toks[i] AS token, i FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM lm_tok) x"),
    ("lm_done", "SELECT a.doc_id, a.i, coalesce(d.lemma, a.token) AS tok FROM lm_at a LEFT JOIN lm_dict d ON a.token = d.token"),
    ("lm_drop", "SELECT tok FROM (SELECT DISTINCT doc_id, tok FROM lm_done) x GROUP BY tok HAVING count(*) > 0.5 * (SELECT count(*) FROM lm_tok)"),
    ("lm_kept", "SELECT doc_id, string_agg(tok, ' ' ORDER BY i) AS clean FROM lm_done WHERE tok NOT IN (SELECT tok FROM lm_drop) GROUP BY doc_id"),
]
ORACLE["lemma_tokens"] = _q("SELECT t.doc_id, coalesce(k.clean, '') AS clean_tags FROM lm_tok t LEFT JOIN lm_kept k ON k.doc_id = t.doc_id", _LEMMA_CTES)

ORACLE["item_clean_tags"] = _q("SELECT id, clean_tags FROM item_clean", _df_cut_ctes("item", "items_tagged", "id", "tags_raw"))

ORACLE["language_index"] = _q("SELECT * FROM items_lang")

ORACLE["runtime_zscore"] = _q("SELECT id, round(runtime_z, 6) AS runtime_z FROM items_rtz")

ORACLE["release_year_bucket"] = _q("""
SELECT id, year, year_bucket, CAST((SELECT max(year_bucket) FROM b) + 1 AS INTEGER) AS n_bucket
FROM b
""", [("b", "SELECT id, year, CAST(greatest(floor(coalesce(year, 0) / 10), 0) AS INTEGER) AS year_bucket FROM items_parsed")])

ORACLE["dedup_items"] = _q("""
SELECT id, source_movieId, title, n_copies
FROM (SELECT CAST(l.tmdbId AS BIGINT) AS id, l.movieId AS source_movieId, coalesce(i.title, i.original_title) AS title,
             row_number() OVER (PARTITION BY CAST(l.tmdbId AS BIGINT) ORDER BY l.movieId) AS rn,
             count(*) OVER (PARTITION BY CAST(l.tmdbId AS BIGINT)) AS n_copies
      FROM raw_links l JOIN raw_items i ON i.id = 100000 + l.movieId
      WHERE l.tmdbId IS NOT NULL) t
WHERE rn = 1
""")

ORACLE["map_ratings"] = _q("SELECT userId, movieId, rating FROM ratings_mapped")

ORACLE["user_split"] = _q("SELECT userId, split FROM user_split")

ORACLE["qualified_users"] = _q("SELECT userId, movieId, rating, split FROM ratings_split")

ORACLE["prune_sparse"] = _q("SELECT userId, movieId, rating FROM pruned")

ORACLE["confidence_matrix"] = _q("""
SELECT c.userId, c.movieId, u.user_idx, it.item_idx, round(c.confidence, 6) AS confidence
FROM (SELECT userId, movieId, sum(1 + 40 * rating) AS confidence FROM pruned GROUP BY userId, movieId) c
JOIN (SELECT userId, row_number() OVER (ORDER BY md5(CAST(userId AS VARCHAR)), userId) - 1 AS user_idx
      FROM (SELECT DISTINCT userId FROM pruned) d) u ON c.userId = u.userId
JOIN (SELECT id, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS item_idx
      FROM (SELECT DISTINCT id FROM items_joined) d) it ON c.movieId = it.id
""")


# ─── recall, negatives, features, metrics ────────────────────────────────


def R6(x: str) -> str:
    """Round to 6 digits; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return f"(round({x}, 6) + 0.0)"


def _h32(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT)"


ITEMS_META = """
SELECT j.id, z.runtime_z, l.lang_idx, j.popularity, j.vote_average, j.vote_count
FROM items_joined j JOIN items_rtz z ON j.id = z.id JOIN items_lang l ON l.id = j.id
"""

POP = """
SELECT split, movieId, count(*) AS n_ratings,
       row_number() OVER (PARTITION BY split ORDER BY count(*) DESC, movieId) AS prank
FROM ratings_split GROUP BY split, movieId
"""

SEEN = "SELECT DISTINCT split, userId, movieId FROM ratings_split"

CANDS = """
SELECT split, userId, movieId, rank, CAST(n_ratings AS DOUBLE) AS score
FROM (SELECT u.split, u.userId, p.movieId, p.n_ratings,
             row_number() OVER (PARTITION BY u.split, u.userId ORDER BY p.prank) AS rank
      FROM (SELECT DISTINCT split, userId FROM ratings_split) u JOIN pop p ON p.split = u.split
      WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.split = u.split AND s.userId = u.userId AND s.movieId = p.movieId)) t
WHERE rank <= 300
"""

POOL = """
SELECT split, movieId,
       row_number() OVER (PARTITION BY split ORDER BY md5(concat(CAST(movieId AS VARCHAR), '_42')), movieId) - 1 AS slot
FROM (SELECT DISTINCT split, movieId FROM ratings_split) d
"""

PPRIME = """
SELECT split, P, min(c) AS PP
FROM (SELECT split, P, P + i AS c FROM (SELECT split, count(*) AS P FROM pool GROUP BY split) ps, range(0, 2000) r(i)) x
WHERE c >= 2 AND NOT EXISTS (SELECT 1 FROM range(2, 3000) d(v) WHERE v * v <= x.c AND x.c % v = 0)
GROUP BY split, P
"""

USERS_POS = """
SELECT DISTINCT r.split, r.userId FROM ratings_split r
WHERE r.rating >= 4 AND r.movieId IN (SELECT id FROM items_meta)
"""

SEEN_COUNT = "SELECT split, userId, count(*) AS m FROM seen GROUP BY split, userId"


def _sampler(name: str, users: str, n: int, stream: str, seen: str = "seen", seen_count: str = "seen_count") -> list[tuple[str, str]]:
    key = lambda tag: f"concat(CAST(u.userId AS VARCHAR), '_42_{stream}_{tag}')"
    return [
        (f"{name}_u", f"""
SELECT u.split, u.userId, pp.PP,
       {_h32(key('o'))} % pp.PP AS o,
       1 + {_h32(key('s'))} % (pp.PP - 1) AS s,
       least({n} + coalesce(sc.m, 0) + (pp.PP - pp.P), pp.PP) AS t_max
FROM {users} u JOIN pprime pp ON u.split = pp.split
LEFT JOIN {seen_count} sc ON sc.split = u.split AND sc.userId = u.userId"""),
        (f"{name}_d", f"SELECT split, userId, t AS draw, (o + s * t) % PP AS slot FROM (SELECT *, unnest(range(0, t_max)) AS t FROM {name}_u) x"),
        (name, f"""
SELECT split, userId, movieId, draw
FROM (SELECT d.split, d.userId, p.movieId, d.draw,
             row_number() OVER (PARTITION BY d.split, d.userId ORDER BY d.draw) AS k
      FROM {name}_d d JOIN pool p ON p.split = d.split AND p.slot = d.slot
      WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.split = d.split AND s.userId = d.userId AND s.movieId = p.movieId)) t
WHERE k <= {n}"""),
    ]


HARD_ALL = """
SELECT split, userId, movieId, rk AS rank
FROM (SELECT c.split, c.userId, c.movieId, row_number() OVER (PARTITION BY c.split, c.userId ORDER BY c.rank, c.movieId) AS rk
      FROM cands c
      WHERE c.movieId IN (SELECT id FROM items_meta)
        AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.split = c.split AND s.userId = c.userId AND s.movieId = c.movieId)) t
WHERE rk <= 20
"""

HARD = """
SELECT h.* FROM hard_all h JOIN users_pos u ON h.split = u.split AND h.userId = u.userId
"""

NEG0 = """
SELECT split, userId, movieId FROM hard
UNION ALL SELECT split, userId, movieId FROM easy WHERE movieId IN (SELECT id FROM items_meta)
"""

USERS_NO_NEG = """
SELECT u.split, u.userId FROM users_pos u
WHERE NOT EXISTS (SELECT 1 FROM neg0 n WHERE n.split = u.split AND n.userId = u.userId)
"""

FEATURES = """
SELECT r.split, r.userId, r.movieId, 1 AS label, m.runtime_z, m.lang_idx, m.popularity,
       m.vote_average AS vote_avg, m.vote_count AS vote_cnt
FROM ratings_split r JOIN items_meta m ON r.movieId = m.id
WHERE r.rating >= 4
  AND EXISTS (SELECT 1 FROM neg_all n JOIN items_meta m2 ON n.movieId = m2.id WHERE n.split = r.split AND n.userId = r.userId)
UNION ALL
SELECT n.split, n.userId, n.movieId, 0 AS label, m.runtime_z, m.lang_idx, m.popularity,
       m.vote_average AS vote_avg, m.vote_count AS vote_cnt
FROM neg_all n JOIN items_meta m ON n.movieId = m.id
"""

LOADED = """
SELECT f.* FROM features f
JOIN (SELECT split, userId FROM features GROUP BY split, userId HAVING sum(label) > 0 AND sum(label) < count(*)) g
  ON f.split = g.split AND f.userId = g.userId
"""

CHAIN2 = [
    ("items_meta", ITEMS_META),
    ("pop", POP),
    ("seen", SEEN),
    ("cands", CANDS),
    ("pool", POOL),
    ("pprime", PPRIME),
    ("users_pos", USERS_POS),
    ("seen_count", SEEN_COUNT),
    ("hard_all", HARD_ALL),
    ("hard", HARD),
    *_sampler("easy", "users_pos", 10, "easy"),
    ("neg0", NEG0),
    ("users_no_neg", USERS_NO_NEG),
    *_sampler("fallback", "users_no_neg", 1, "fallback"),
    ("neg_all", "SELECT split, userId, movieId FROM neg0 UNION ALL SELECT split, userId, movieId FROM fallback"),
    ("features", FEATURES),
    ("loaded", LOADED),
]


def _q2(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_ctes(BASE + CHAIN2 + (extra or []), body)


def _idcg(n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN list_sum(list_transform(range(1, CAST({n} AS BIGINT) + 1), lambda i: 1.0 / log2(i + 1))) ELSE 0.0 END"


WALK, N_WEIGHTED = 20, 10
_wkey = lambda tag: f"concat(CAST(u.userId AS VARCHAR), '_42_weighted_{tag}')"
WEIGHTED = [
    ("wslots", """
SELECT split, movieId,
       row_number() OVER (PARTITION BY split ORDER BY md5(concat(CAST(userId AS VARCHAR), '_', CAST(movieId AS VARCHAR), '_42')), userId, movieId) - 1 AS slot
FROM ratings_split"""),
    ("wprime", PPRIME.replace("FROM pool", "FROM wslots")),
    ("wdraws", f"""
SELECT u.split, u.userId, t AS draw, ({_h32(_wkey('o'))} % w.PP + (1 + {_h32(_wkey('s'))} % greatest(w.PP - 1, 1)) * t) % w.PP AS slot
FROM users_pos u JOIN wprime w ON u.split = w.split, range(0, {WALK * N_WEIGHTED}) r(t) WHERE t < w.PP"""),
    ("wgot", f"""
SELECT split, userId, movieId, draw FROM (
  SELECT split, userId, movieId, draw, row_number() OVER (PARTITION BY split, userId ORDER BY draw) AS k FROM (
    SELECT d.split, d.userId, s.movieId, min(d.draw) AS draw FROM wdraws d JOIN wslots s ON s.split = d.split AND s.slot = d.slot
    GROUP BY d.split, d.userId, s.movieId) m
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.split = m.split AND s.userId = m.userId AND s.movieId = m.movieId)) t
WHERE k <= {N_WEIGHTED}"""),
    ("wlack", f"""
SELECT u.split, u.userId, count(g.movieId) AS have FROM users_pos u LEFT JOIN wgot g ON g.split = u.split AND g.userId = u.userId
GROUP BY u.split, u.userId HAVING count(g.movieId) < {N_WEIGHTED}"""),
    ("wtaken", "SELECT split, userId, movieId FROM seen UNION ALL SELECT split, userId, movieId FROM wgot"),
    ("wtaken_count", "SELECT split, userId, count(*) AS m FROM wtaken GROUP BY split, userId"),
    *_sampler("wtop", "wlack", N_WEIGHTED, "topup", "wtaken", "wtaken_count"),
]
ORACLE["weighted_negatives"] = _q2(
    f"""SELECT split, userId, movieId, draw FROM wgot UNION ALL
SELECT split, userId, movieId, draw + {WALK * N_WEIGHTED} FROM (
  SELECT t.*, l.have, row_number() OVER (PARTITION BY t.split, t.userId ORDER BY t.draw) AS k2
  FROM wtop t JOIN wlack l ON l.split = t.split AND l.userId = t.userId) x WHERE k2 <= {N_WEIGHTED} - have""",
    WEIGHTED,
)
ORACLE["seen_mask"] = _q2("SELECT split, userId, movieId, rank FROM cands")
ORACLE["hard_negatives"] = _q2("SELECT split, userId, movieId, rank FROM hard_all")
ORACLE["easy_negatives"] = _q2("SELECT split, userId, movieId, draw FROM easy")
ORACLE["fallback_negatives"] = _q2("SELECT split, userId, movieId, draw FROM fb_all", _sampler("fb_all", "users_pos", 1, "fallback"))
ORACLE["feature_rows"] = _q2(f"""
SELECT split, userId, movieId, label, {R6('runtime_z')} AS runtime_z, lang_idx, popularity, vote_avg, vote_cnt FROM features
""")
ORACLE["group_sizes"] = _q2("""
SELECT split, userId, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos FROM features
GROUP BY split, userId HAVING sum(label) > 0 AND sum(label) < count(*)
""")

_METRIC_CTES = [
    ("rk", "SELECT split, userId, movieId, label, row_number() OVER (PARTITION BY split, userId ORDER BY popularity DESC, movieId) AS rn FROM loaded"),
    ("tp", "SELECT *, sum(label) OVER (PARTITION BY split, userId ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits FROM rk WHERE rn <= 10"),
    ("nm", """SELECT split, userId, sum(CASE WHEN label = 1 THEN hits / rn ELSE 0 END) AS ap_num,
                     sum(label / log2(rn + 1)) AS dcg, sum(label) AS top_hits FROM tp GROUP BY split, userId"""),
    ("st", "SELECT split, userId, sum(label) AS n_pos FROM loaded GROUP BY split, userId"),
    ("pu", f"""SELECT st.split, st.userId,
                      CASE WHEN st.n_pos > 0 AND nm.top_hits > 0 THEN nm.ap_num / least(st.n_pos, 10) ELSE 0.0 END AS ap,
                      CASE WHEN {_idcg('least(st.n_pos, 10)')} > 0 THEN nm.dcg / {_idcg('least(st.n_pos, 10)')} ELSE 0.0 END AS ndcg
               FROM st JOIN nm ON st.split = nm.split AND st.userId = nm.userId"""),
]
ORACLE["map_ndcg"] = _q2(f"""
SELECT split, 10 AS k, {R6('avg(ap)')} AS map_at_k, {R6('avg(ndcg)')} AS ndcg_at_k, count(*) AS n_users FROM pu GROUP BY split
""", _METRIC_CTES)

_LAMBDA_CTES = [
    ("lr", "SELECT userId, movieId, label, vote_avg / 10 AS score FROM loaded WHERE split = 'train'"),
    ("lk", "SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rn FROM lr"),
    ("ls", f"""SELECT userId, 1.0 / ({_idcg('least(sum(label), 30)')}) AS inv_idcg, max(score) <> min(score) AS spread
               FROM lk GROUP BY userId"""),
    ("lp", """SELECT h.userId, h.rn AS rn_h, o.rn, h.label > o.label AS h_high,
                     CASE WHEN h.label > o.label THEN h.score - o.score ELSE o.score - h.score END AS ds,
                     abs(1.0 / log2(h.rn + 1) - 1.0 / log2(o.rn + 1)) * ls.inv_idcg AS d0, ls.spread
              FROM lk h JOIN lk o ON h.userId = o.userId AND o.rn > h.rn AND o.label <> h.label
              JOIN ls ON ls.userId = h.userId
              WHERE h.rn <= 30"""),
    ("lq", "SELECT *, CASE WHEN spread THEN d0 / (0.01 + abs(ds)) ELSE d0 END AS dn, 1.0 / (1.0 + exp(ds)) AS rho FROM lp"),
    ("lm", "SELECT userId, rn_h, rn, h_high, dn * rho AS lam, dn * rho * (1.0 - rho) AS hs FROM lq"),
    ("lc", """SELECT userId, rn_h AS rn, CASE WHEN h_high THEN -lam ELSE lam END AS g, hs AS h FROM lm
              UNION ALL SELECT userId, rn, CASE WHEN h_high THEN lam ELSE -lam END AS g, hs AS h FROM lm"""),
    ("lt", "SELECT userId, 2.0 * sum(lam) AS S FROM lm GROUP BY userId"),
    ("lg", """SELECT c.userId, c.rn,
                     sum(c.g) * CASE WHEN t.S > 0 THEN log2(1 + t.S) / t.S ELSE 1.0 END AS grad,
                     sum(c.h) * CASE WHEN t.S > 0 THEN log2(1 + t.S) / t.S ELSE 1.0 END AS hess
              FROM lc c JOIN lt t ON c.userId = t.userId GROUP BY c.userId, c.rn, t.S"""),
]
ORACLE["lambda_gradients"] = _q2(f"""
SELECT lk.userId, lk.movieId, lk.label, lk.rn, {R6('coalesce(lg.grad, 0.0)')} AS grad, {R6('coalesce(lg.hess, 0.0)')} AS hess
FROM lk LEFT JOIN lg ON lk.userId = lg.userId AND lk.rn = lg.rn
""", _LAMBDA_CTES)


# ─── vectors, kNN and list blending ──────────────────────────────────────


def _normed(v: str) -> str:
    nrm = f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
    return f"list_transform({v}, lambda x: x / CASE WHEN {nrm} = 0 THEN 1.0 ELSE {nrm} END)"


EMB_N = f"SELECT vec_id AS id, {_normed('CAST(embedding AS DOUBLE[])')} AS v FROM embeddings"
EMB_RAW = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"

ORACLE["knn_cosine"] = _q(f"""
SELECT qid, iid, rank, {R6('score')} AS score
FROM (SELECT a.id AS qid, b.id AS iid, list_dot_product(a.v, b.v) AS score,
             row_number() OVER (PARTITION BY a.id ORDER BY round(list_dot_product(a.v, b.v), 9) DESC, b.id) AS rank
      FROM en a, en b) t
WHERE rank <= 300
""", [("en", EMB_N)])

ORACLE["knn_l2"] = _q(f"""
SELECT qid, iid, rank, {R6('score')} AS score
FROM (SELECT a.id AS qid, b.id AS iid, list_distance(a.v, b.v) AS score,
             row_number() OVER (PARTITION BY a.id ORDER BY round(list_distance(a.v, b.v), 9), b.id) AS rank
      FROM er a, er b) t
WHERE rank <= 300
""", [("er", EMB_RAW)])

HV_CTES = [
    ("hv_in", """SELECT j.id, l.lang_idx, z.runtime_z, p.year,
                        CAST(greatest(floor(coalesce(p.year, 0) / 10), 0) AS INTEGER) AS yb
                 FROM items_joined j JOIN items_lang l ON l.id = j.id JOIN items_rtz z ON z.id = j.id
                 JOIN items_parsed p ON p.id = j.id"""),
    ("hv_dims", """SELECT (SELECT max(len(embedding)) FROM embeddings) AS d, (SELECT count(*) FROM lang_order) AS nl,
                          (SELECT max(yb) + 1 FROM hv_in) AS nb"""),
    ("hv_raw", """SELECT h.id,
                  list_concat(list_concat(list_concat(
                      coalesce(CAST(e.embedding AS DOUBLE[]), list_transform(range(k.d), lambda i: 0.0)),
                      list_transform(range(k.nl), lambda i: CASE WHEN i = h.lang_idx THEN 1.0 ELSE 0.0 END)),
                      [CAST(coalesce(h.runtime_z, 0.0) AS DOUBLE)]),
                      list_transform(range(k.nb), lambda i: CASE WHEN i = h.yb THEN 1.0 ELSE 0.0 END)) AS v
                  FROM hv_in h CROSS JOIN hv_dims k LEFT JOIN embeddings e ON e.vec_id = h.id - 100000"""),
    ("hv", f"SELECT id, {_normed('v')} AS v FROM hv_raw"),
]

ORACLE["hybrid_vectors"] = _q2(f"""
SELECT id, dim, {R6('value')} AS value
FROM (SELECT id, unnest(range(len(v))) AS dim, unnest(v) AS value FROM hv) t
WHERE value <> 0
""", HV_CTES)

SEED_CTES = HV_CTES + [
    ("seeds", "SELECT split, userId, movieId AS seed FROM cands WHERE rank = 1"),
    ("nb", """SELECT qid, iid, rank, score
              FROM (SELECT s.seed AS qid, h.id AS iid, list_dot_product(hs.v, h.v) AS score,
                           row_number() OVER (PARTITION BY s.seed ORDER BY round(list_dot_product(hs.v, h.v), 9) DESC, h.id) AS rank
                    FROM (SELECT DISTINCT seed FROM seeds) s JOIN hv hs ON hs.id = s.seed CROSS JOIN hv h) t
              WHERE rank <= 300"""),
    ("ct", "SELECT s.split, s.userId, nb.iid AS movieId, nb.rank, nb.score FROM seeds s JOIN nb ON s.seed = nb.qid"),
    ("mr", """SELECT split, userId, movieId, rank AS r, 0 AS src FROM cands
              UNION ALL
              SELECT c.split, c.userId, c.movieId, c.rank AS r, 1 AS src FROM ct c
              WHERE EXISTS (SELECT 1 FROM cands m WHERE m.split = c.split AND m.userId = c.userId)"""),
]

ORACLE["seed_neighbours"] = _q2(f"SELECT split, userId, movieId, rank, {R6('score')} AS score FROM ct", SEED_CTES)

ORACLE["merge_union"] = _q2("""
SELECT split, userId, movieId, pos FROM (
  SELECT split, userId, movieId, row_number() OVER (PARTITION BY split, userId ORDER BY k) AS pos
  FROM (SELECT split, userId, movieId, min(src * 1000000 + r) AS k FROM mr GROUP BY split, userId, movieId) a) b
WHERE pos <= 300
""", SEED_CTES)

ORACLE["merge_interleave"] = _q2("""
SELECT split, userId, movieId, pos FROM (
  SELECT split, userId, movieId, row_number() OVER (PARTITION BY split, userId ORDER BY k) AS pos
  FROM (SELECT mr.split, mr.userId, mr.movieId, min(2 * (mr.r - 1) + mr.src) AS k
        FROM mr JOIN (SELECT split, userId, least(max(r) FILTER (WHERE src = 0), max(r) FILTER (WHERE src = 1)) AS m
                      FROM mr GROUP BY split, userId) l ON mr.split = l.split AND mr.userId = l.userId
        WHERE mr.r <= l.m
        GROUP BY mr.split, mr.userId, mr.movieId) a) b
WHERE pos <= 300
""", SEED_CTES)

ORACLE["merge_weighted"] = _q2("""
SELECT split, userId, movieId, pos FROM (
  SELECT split, userId, movieId,
         row_number() OVER (PARTITION BY split, userId ORDER BY score DESC, mf_r ASC NULLS LAST, ct_r ASC) AS pos
  FROM (SELECT mr.split, mr.userId, mr.movieId, sum(0.5 * (l.len - mr.r + 1)) AS score,
               min(CASE WHEN mr.src = 0 THEN mr.r END) AS mf_r, min(CASE WHEN mr.src = 1 THEN mr.r END) AS ct_r
        FROM mr JOIN (SELECT split, userId, src, max(r) AS len FROM mr GROUP BY split, userId, src) l
          ON mr.split = l.split AND mr.userId = l.userId AND mr.src = l.src
        GROUP BY mr.split, mr.userId, mr.movieId) a) b
WHERE pos <= 300
""", SEED_CTES)


# ─── text ────────────────────────────────────────────────────────────────

TFIDF_CTES = [
    ("tk", f"SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{WORD2}'), lambda t: NOT list_contains({STOP}, t)) AS u FROM documents"),
    ("tg", """SELECT doc_id, list_concat(u, list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) AS g FROM tk"""),
    ("tt", "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM tg) x GROUP BY doc_id, term"),
    ("tv", """SELECT term, count(*) AS df, sum(tf) AS tf_total FROM tt GROUP BY term HAVING count(*) >= 3
              ORDER BY tf_total DESC, term LIMIT 20000"""),
    ("tw", """SELECT t.doc_id, t.term, t.tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + v.df)) + 1.0) AS w
              FROM tt t JOIN tv v ON t.term = v.term"""),
]
ORACLE["tfidf_weights"] = _q(f"""
SELECT doc_id, term, {R6('w / CASE WHEN nrm = 0 THEN 1.0 ELSE nrm END')} AS weight
FROM (SELECT doc_id, term, w, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS nrm FROM tw) x
""", TFIDF_CTES)


# ─── invariants of learned results ───────────────────────────────────────

ORACLE["als_factors_checks"] = _q("""
SELECT 'user' AS kind, count(DISTINCT userId) AS n_rows, count(DISTINCT userId) AS n_ids, CAST(0 AS BIGINT) AS n_other_dim, CAST(0 AS BIGINT) AS n_not_finite FROM pruned
UNION ALL SELECT 'item', count(DISTINCT movieId), count(DISTINCT movieId), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM pruned
""")
ORACLE["als_recall_checks"] = _q2("""
SELECT split, count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_pairs, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_unknown, CAST(0 AS BIGINT) AS n_rank_gaps, CAST(0 AS BIGINT) AS n_out_of_order
FROM (SELECT u.split, u.userId,
             least(300, (SELECT count(DISTINCT id) FROM items_joined) - (SELECT count(DISTINCT s.movieId) FROM seen s WHERE s.split = u.split AND s.userId = u.userId AND s.movieId IN (SELECT id FROM items_joined))) AS n
      FROM (SELECT DISTINCT split, userId FROM ratings_split WHERE userId IN (SELECT userId FROM pruned)) u) t
GROUP BY split
""")
ORACLE["svd_checks"] = _q("SELECT count(DISTINCT doc_id) AS n_docs, CAST(0 AS BIGINT) AS n_too_long, CAST(0 AS BIGINT) AS n_rising, true AS orthogonal FROM tw", TFIDF_CTES)
ORACLE["ranker_checks"] = _q2("SELECT count(*) AS n_rows, count(DISTINCT userId) AS n_users, CAST(0 AS BIGINT) AS n_bad FROM loaded WHERE split = 'valid'")
