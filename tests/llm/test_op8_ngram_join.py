"""Components and sizes equal a brute-force join over all pairs; edge cases are as documented."""

import itertools
import random
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from cinerank.llm import common
from cinerank.llm import op8_ngram_join as op8

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    s = [(i, shingle_set(t)) for i, t in rows]
    up = list(range(len(s)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(s), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            up[find(j)] = find(i)
    low = {}
    for k, (d, _) in enumerate(s):
        low[find(k)] = min([x for x in (low.get(find(k)), d) if x is not None], default=None)
    return sorted(((d, len(a), low[find(k)]) for k, (d, a) in enumerate(s)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op8.ngram_components(df).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_near_copies_chains_and_shared_passages(make, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "eta", "zeta"]) + str(rng.randrange(200))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 30, 80, 200]))]
        for _ in range(rng.randrange(1, 6)):  # a chain: each copy edits the one before
            rows.append((rng.randrange(10**6), " ".join(base)))
            base = [w if rng.random() > 0.02 else word() for w in base]
    for _ in range(60):  # unrelated documents that share a passage
        rows.append((rng.randrange(10**6), " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])))
    many = [word() for _ in range(60)]
    for _ in range(60):  # a large group of near copies around the threshold
        w = list(many)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = word()
        rows.append((rng.randrange(10**6), " ".join(w)))
    assert got(make(rows)) == brute(rows)


def test_nulls_short_texts_ties_and_repeats(make):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(5, None), (4, ""), (3, " \n\t"), (2, "one two"), (9, "ONE\ttwo "), (None, "one two"), (7, "é É"), (8, "É é"), (6, "a b c d e"), (6, "a b c d e"), (1, "a b c d e"), (11, long), (12, long + " end")]
    want = brute(rows)
    assert got(make(rows)) == want
    assert (2, 1, 2) in want and (9, 1, 2) in want and (None, 1, 2) in want


def test_null_ids_alone_and_empty_table(make):
    assert got(make([(None, "a b c d e f"), (None, "a b c d e f")])) == [(None, 2, None)] * 2
    assert got(make([])) == []


def test_keep_one_keeps_smallest_and_all_columns(make):
    df = make([(3, "a b c d e f"), (1, "a b c d e f"), (2, "other"), (4, None), (None, "x")])
    out = op8.keep_one(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4", "None"]


def test_keep_one_of_repeated_rows_null_ids_and_reused_ids(make):
    text, other, third = "a b c d e f", "g h i j k l", "m n o p q r"
    rows = [(1, text), (1, text), (5, text), (None, text), (None, other), (None, other), (None, other + " x"), (5, third), (6, None), (6, None)]
    out = sorted((str(r.doc_id), r.text) for r in op8.keep_one(make(rows), pct=60).collect())
    assert [x for x in out if x[0] != "None"] == [("1", text), ("5", third), ("6", None), ("6", None)]
    assert len([x for x in out if x[0] == "None"]) == 1


def test_parameters():
    with pytest.raises(ValueError):
        op8.classes_and_links(None, n=0)


class NoCommon:
    value = np.zeros(0, np.uint64)


def test_steps_hand_over_small_batches():
    """Shared shingles and prefixes leave a task in batches under 1 MB, with the counts of the whole chunk."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)) for _ in range(20)]
    rb = pa.record_batch({"doc_id": pa.array(range(41), pa.int64()), "text": pa.array([*texts, *[t + " end" for t in texts], ""])})
    sets = [s for _, s in op8._sets(iter([rb]), 5)]
    out = list(op8._scan(5)(iter([rb])))
    assert max(b.nbytes for b in out) < 1 << 20
    rows = pa.Table.from_batches(out)
    tok, cnt = np.unique(np.concatenate(sets), return_counts=True)
    shared = rows.filter(pc.is_valid(rows["token"]))
    assert shared["token"].to_numpy().view(np.uint64).tolist() == tok[cnt > 1].tolist()
    assert shared["df"].to_pylist() == cnt[cnt > 1].tolist()
    docs = rows.filter(pc.is_valid(rows["cid"]))
    assert docs["doc_id"].to_pylist() == list(range(41)) and docs["size"].to_pylist() == [len(s) for s in sets]
    out = list(op8._postings(5, 80, NoCommon)(iter([rb.slice(0, 40)])))
    assert max(b.nbytes for b in out) < 1 << 20 and sum(b.num_rows for b in out) == sum(op8._prefix_sizes(len(s), 80)[1] for s in sets[:40])


WITHOUT_PANDAS = """
import sys
import numpy as np
import pyarrow as pa
from cinerank.llm import common, op2_quality as op2, op8_ngram_join as op8

class NoCommon:
    value = np.zeros(0, np.uint64)

class Model:
    def score(self, x):
        return x[:, 0].astype(float)

rb = next(pa.ipc.open_stream(sys.stdin.buffer))
for step in (op8._scan(5), op8._postings(5, 80, NoCommon), op8._whole(5, 80, NoCommon), op8._row_classes(5), op2._sample_features):
    assert sum(b.num_rows for b in step(iter([rb])))
assert op2.N_FEATURES * 4 == len(next(op2._sample_features(iter([rb]))).column(3)[0].as_py())
assert "pandas" not in sys.modules
"""


def test_steps_leave_pandas_out_of_a_python_worker():
    text = "some words of a text that is long enough"
    ids = pa.array([1, 2], pa.int64())
    rb = pa.record_batch({"doc_id": ids, "text": pa.array([text, text + " end"]), "th": ids, "p": pa.array([1, 0], pa.int32()), "u": pa.array([0, 1], pa.int32())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rb.schema) as w:
        w.write_batch(rb)
    done = subprocess.run([sys.executable, "-c", WITHOUT_PANDAS], input=sink.getvalue().to_pybytes(), capture_output=True, check=False)
    assert done.returncode == 0, done.stderr.decode()


def test_column():
    x = np.arange(20)
    assert common.column(x[::2]).to_pylist() == list(range(0, 20, 2))
    assert common.column(x, x % 3 > 0).to_pylist() == [i if i % 3 else None for i in range(20)]
    assert common.column(x % 3 == 0).to_pylist() == [i % 3 == 0 for i in range(20)]
    assert common.column(x[:0]).to_pylist() == []


def test_written_reads_without_copies_and_restores_the_session(monkeypatch, spark):
    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", common.VECTORED_READS)
    before, seen, writer = [spark.conf.get(k, None) for k in keys], [], type(spark.range(1).write)
    plain = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **b: seen.append([spark.conf.get(k, None) for k in keys]) or plain(self, path, *a, **b))
    assert common.written(spark.range(5), "small", common.SMALL_BATCH_BYTES).count() == 5
    assert seen == [[str(common.SMALL_BATCH_BYTES), "false"]] and [spark.conf.get(k, None) for k in keys] == before
