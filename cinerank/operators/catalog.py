"""Item catalogue preparation (first half of the prepare job).

JN1 PRJ1-3 SCL1-12 SET8 AGG1-4 JN19-20 WIN6 TOP1 LIM1 DST2.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions import nested
from cinerank.functions.text import WORD, tokens
from cinerank.session import checkpoint_dir

# Job defaults of the prepare step.
CAST_N = 5
DF_CUT = 0.50
MISSING_LANGUAGE = "xx"
YEAR_BUCKET = 10
#: Entries of a dictionary that is copied to every task.
DICTIONARY_ROWS = 500_000


def join_credits(items: DataFrame, credits: DataFrame) -> DataFrame:
    """JN1 + PRJ1 + PRJ2: inner join on id = movie_id (fan-out kept), drop the key, resolve the title.

    Both sides are item-sized; the planner picks broadcast or sort-merge from
    their sizes.  When both inputs carry ``title`` the item side's titles are
    shadowed (as a suffixing merge would), so ``original_title`` wins.
    """
    both_titles = "title" in items.columns and "title" in credits.columns
    if both_titles:
        items = items.withColumnRenamed("title", "_title_items")
        credits = credits.withColumnRenamed("title", "_title_credits")
    j = items.join(credits, items["id"] == credits["movie_id"], "inner").drop("movie_id")
    cols = j.columns
    if "title" not in cols and "original_title" in cols:
        j = j.withColumnRenamed("original_title", "title")
    elif "original_title" in cols:
        j = j.withColumn("title", F.coalesce("title", "original_title")).drop("original_title")
    return j.drop("_title_items", "_title_credits")


def parse_lists(df: DataFrame, cast_n: int = CAST_N) -> DataFrame:
    """SCL1-SCL5, TOP1, LIM1: genres/keywords/cast/director lists, country, release year."""
    g = nested.object_list(F.col("genres"))
    k = nested.object_list(F.col("keywords"))
    c = nested.object_list(F.col("cast_list"))
    crew = nested.object_list(F.col("crew"))
    countries = nested.object_list(F.col("production_countries"))
    return df.select(
        "*",
        nested.names(g).alias("genres_list"),
        nested.names(k).alias("keywords_list"),
        F.slice(nested.names(c), 1, cast_n).alias("cast_names"),
        nested.names_where(crew, "job", "Director").alias("directors"),
        nested.first_field(countries, "iso_3166_1").alias("country_iso"),
        F.year(F.try_to_date(F.col("release_date"))).alias("year"),
    )


def tag_strings(parsed: DataFrame) -> DataFrame:
    """SET8 + SCL6-7: one space-joined, lower-cased, space-free tag string per item."""
    return parsed.withColumn(
        "tags_raw",
        nested.tag_string(
            [F.col("genres_list"), F.col("keywords_list"), F.col("cast_names"), F.col("directors")],
            F.col("country_iso"),
        ),
    )


def content_tokens(df: DataFrame, text_col: str, out: str = "lemmas") -> DataFrame:
    """SCL8 re-aimed: word tokens minus English stop words, in text order.

    The reference runs a neural lemmatiser; here tokens stay as written
    (identity lemma) unless a dictionary is joined by ``lemmatised``.  Stop words
    are removed by ``StopWordsRemover`` (JVM-side hash-set lookup).
    """
    with_tokens = df.withColumn("_tokens", tokens(F.col(text_col), WORD))
    remover = StopWordsRemover(inputCol="_tokens", outputCol=out)
    return remover.transform(with_tokens).drop("_tokens")


def lemmatised(df: DataFrame, dictionary: DataFrame, key: str, lemma_col: str = "lemmas") -> DataFrame:
    """SCL8: every token of ``lemma_col`` replaced by its lemma in ``dictionary`` (token, lemma), in place.

    ``key`` identifies a row.  Tokens are joined by value, so the dictionary may be of any size (one of at most
    DICTIONARY_ROWS entries is copied to the tasks, so that rows dealt by ``key`` need no shuffle of tokens; with a
    larger one adaptive execution splits frequent tokens), and put back by position.  Tokens
    that the dictionary does not have, or has without a lemma, stay; the smallest of several lemmas counts.
    """
    d = dictionary.where("token IS NOT NULL AND lemma IS NOT NULL").groupBy("token").agg(F.min("lemma").alias("lemma"))
    checkpoint_dir(df.sparkSession)
    d = d.checkpoint(eager=True)
    d = F.broadcast(d) if d.count() <= DICTIONARY_ROWS else d
    at = df.select(F.col(key).alias("_key"), F.posexplode(lemma_col).alias("_pos", "token")).join(d, "token", "left")
    at = at.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("lemma", "token").alias("t")))).alias("_at"))
    out = df.join(at, df[key].eqNullSafe(at["_key"]), "left")
    done = F.coalesce(F.transform("_at", lambda x: x["t"]), F.array().cast("array<string>"))
    return out.withColumn(lemma_col, done).drop("_key", "_at")


def df_cut(df: DataFrame, lemma_col: str = "lemmas", out: str = "clean_tags", cut: float = DF_CUT) -> DataFrame:
    """AGG1-2 + JN20 + SCL9: drop tokens found in more than ``cut`` of the rows.

    Document frequency is a partial+final aggregate on the token.  The
    dropped set is tiny by construction: a token is dropped only if it is in
    more than ``cut * N`` rows, so |dropped| <= (mean distinct tokens per row)
    / cut.  It travels as one scalar-subquery array, and the row-wise filter
    keeps order and repeats without regrouping the tokens.
    """
    if not 0 < cut <= 1:
        raise ValueError("cut must be within (0, 1]: it bounds the dropped set")
    n_rows = df.select(F.count(F.lit(1))).scalar()
    doc_freq = (
        df.select(F.explode(F.array_distinct(F.col(lemma_col))).alias("tok"))
        .groupBy("tok")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    dropped = doc_freq.filter(F.col("df") > F.lit(cut) * n_rows).select(
        F.coalesce(F.collect_list("tok"), F.array().cast("array<string>"))
    ).scalar()
    return (
        df.withColumn("_dropped", dropped)
        .withColumn(out, F.array_join(F.filter(F.col(lemma_col), lambda t: ~F.array_contains(F.col("_dropped"), t)), " "))
        .drop("_dropped")
    )


def runtime_z(df: DataFrame, out: str = "runtime_z") -> DataFrame:
    """SCL10-11 + AGG3: population z-score of runtime; 0 and null are missing and stay null."""
    rt = F.nullif(F.coalesce(F.col("runtime"), F.lit(0.0)), F.lit(0.0))
    # one aggregate row, so that the mean and the deviation cost one pass
    stat = df.select(rt.alias("rt")).select(F.struct(F.avg("rt").alias("mu"), F.stddev_pop("rt").alias("sd"))).scalar()
    sd = stat["sd"]
    scale = F.when((sd.isNull()) | (sd == 0), F.lit(1.0)).otherwise(sd)
    return df.withColumn(out, (rt - stat["mu"]) / scale)


def language_order(df: DataFrame) -> DataFrame:
    """AGG4 + WIN6: (original_language, n, lang_idx), most frequent first, ties alphabetical.

    The window runs over the aggregated language table (one row per language).
    """
    lang = F.coalesce(F.col("original_language"), F.lit(MISSING_LANGUAGE))
    counts = df.groupBy(lang.alias("original_language")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc("original_language"))
    return counts.withColumn("lang_idx", (F.row_number().over(w) - 1).cast("int"))


def with_language_index(df: DataFrame, order: DataFrame) -> DataFrame:
    """JN19 + SCL12: map the (null → 'xx') language to its index by a broadcast join.

    The language dimension has one row per ISO language code, a fixed bound.
    """
    dim = F.broadcast(order.select(F.col("original_language").alias("_lang"), "lang_idx"))
    lang = F.coalesce(F.col("original_language"), F.lit(MISSING_LANGUAGE))
    return df.join(dim, lang == F.col("_lang"), "left").drop("_lang")


def year_bucket(df: DataFrame, size: int = YEAR_BUCKET) -> DataFrame:
    """SCL14 + AGG16: bucket = max(floor(coalesce(year, 0) / size), 0); n_bucket = max(bucket) + 1."""
    b = F.greatest(F.floor(F.coalesce(F.col("year"), F.lit(0)) / F.lit(size)), F.lit(0)).cast("int")
    d = df.withColumn("year_bucket", b)
    n_bucket = d.select((F.max("year_bucket") + 1).cast("int")).scalar()
    return d.withColumn("n_bucket", n_bucket)


def first_per_key(df: DataFrame, key: str, order_col: str, keep: list[str]) -> DataFrame:
    """DST2: keep the row with the smallest ``order_col`` per ``key``; count the copies.

    ``min(struct(order, ...))`` is an ordinary aggregate, so partial
    aggregation collapses a hot key map-side instead of sorting it in one task.
    """
    agg = df.groupBy(key).agg(
        F.min(F.struct(order_col, *keep)).alias("_first"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    return agg.select(key, *[F.col(f"_first.{c}").alias(c) for c in [order_col, *keep]], "n_copies")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """DST2 at the source: of rows with the same ``key`` the smallest (by the other columns) stays.

    Same columns and order as ``df``; a map-side-combined ``min(struct)``.
    """
    rest = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return agg.select(key, "_row.*").select(*df.columns)


def items_processed(items: DataFrame, credits: DataFrame, cast_n: int = CAST_N, cut: float = DF_CUT):
    """The prepare job's item table (PRJ3) and language order.

    Returns (items_processed, lang_order).  Columns: id, title, genres_list,
    clean_tags, lang_idx, runtime_z, popularity, vote_average, vote_count,
    original_language, year.
    """
    j = join_credits(items, credits)
    p = tag_strings(parse_lists(j, cast_n))
    p = df_cut(content_tokens(p, "tags_raw"), cut=cut)
    p = runtime_z(p)
    order = language_order(p)
    p = with_language_index(p, order)
    out = p.select(
        "id", "title", "genres_list", "clean_tags", "lang_idx", "runtime_z",
        "popularity", "vote_average", "vote_count", "original_language", "year",
    )
    return out, order
