"""Raw inputs: CSV columns by header name, and every spelling of nested lists."""

import pytest
from pyspark.sql import functions as F

from cinerank.functions import nested
from cinerank.sources import io


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_ratings_with_extra_and_reordered_columns(spark, tmp_path):
    p = write(tmp_path, "r.csv", "note,rating,movieId,userId,timestamp\nx,3.5,10,1,99\n,bad,11,2,\n")
    rows = io.read_ratings_csv(spark, p).collect()
    assert [tuple(r) for r in rows] == [(1, 10, 3.5, 99), (2, 11, None, None)]


def test_items_without_optional_title_and_with_line_ends(spark, tmp_path):
    head = "homepage,id,original_title,genres,keywords,production_countries,release_date,runtime,original_language,popularity,vote_average,vote_count"
    p = write(tmp_path, "i.csv", head + '\nh,7,"A ""quoted""\ntitle","[{\'name\': \'x, y\'}]",[],[],2001-01-01,90,en,1.5,7.0,12\n')
    r = io.read_items_csv(spark, p).first()
    assert (r.id, r.title, r.original_title, r.genres, r.runtime, r.vote_count) == (7, None, 'A "quoted"\ntitle', "[{'name': 'x, y'}]", 90.0, 12)


def test_missing_required_column_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="movieId"):
        io.read_ratings_csv(spark, write(tmp_path, "r.csv", "userId,rating\n1,2\n"))


def test_links_and_credits(spark, tmp_path):
    links = io.read_links_csv(spark, write(tmp_path, "l.csv", "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n")).collect()
    assert [tuple(r) for r in links] == [(1, 862.0), (2, None)]
    c = io.read_credits_csv(spark, write(tmp_path, "c.csv", 'crew,title,cast,movie_id\n[],t,"[{""name"": ""A""}]",5\n')).first()
    assert (c.movie_id, c.cast_list, c.crew) == (5, '[{"name": "A"}]', "[]")


CASES = [
    ("[{'name': 'x'}]", ["x"]),
    ('[{"name": "x"}, {"name": null}]', ["x", None]),
    ("[None, {'name': 'x'}]", ["x"]),
    ("[{'name': 'x'},]", ["x"]),
    ("[{'name': 'x', 'ids': (1, 2)}]", ["x"]),
    ("({'name': 'x'}, {'id': 3})", ["x", ""]),
    ("[{'name': 'Say: None'}]", ["Say: None"]),
    ("[{'name': 'True (story), None'}, {'flag': True, 'name': 'b'}]", ["True (story), None", "b"]),
    ("[{'name': \"it's, ]\"}]", ["it's, ]"]),
    ("[{'name': 'it\\'s'}]", ["it's"]),
    ("[{'name': '" + "long " * 20_000 + "'}]", ["long " * 20_000]),
    ("{'name': 'x'}", []),
    ("not a list", []),
    ("[]", []),
    (None, []),
]


def test_nested_literals(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    rows = df.select("i", nested.names(nested.object_list(F.col("t"))).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [want for _, want in CASES]


def test_literals_as_python_reads_them(spark):
    """Whatever Python's JSON reader or literal syntax accepts, and nothing else."""
    import ast
    import json

    texts = [
        "[{u'name': u'x'}]", r"[{'name': '\x41é'}]", "[{'name': 'a' 'b'}]", "({'name': 'x'}, {'name': None})", "[{'name': 'it\\'s'}, {'id': 1}]",
        "{'name': 'lone'}", "'name'", "[{'name': 'x',},]", "[{'name': true}]", '[{"name": NaN}]', '[{"name": "a", "name": "b"}]', '[{"name": "[(None)]"}]',
        "[[{'name': 'deep'}]]", "[1, 'x', {'name': 'y'}]", "[{'name': 'x'}", "__import__('os')", "[" * 500, "", "[{'name': 'tab\\t'}]", '[{"name": "\\u0041"}]',
    ]

    def python(t):
        try:
            v = json.loads(t)
        except Exception:  # noqa: BLE001
            try:
                v = ast.literal_eval(t)
            except Exception:  # noqa: BLE001
                return []
        return [o.get("name", "") for o in v if isinstance(o, dict)] if isinstance(v, (list, tuple)) else []

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.n for r in df.select("i", nested.names(nested.object_list(F.col("t"))).alias("n")).orderBy("i").collect()]
    want = [python(t) for t in texts]
    want[9] = []  # a NaN has no JSON form
    assert got == want
