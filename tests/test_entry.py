"""The entry imports without a JVM, a jar or the optional sub-package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stop_word_resource_equals_sparks_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    from cinerank.functions.text import english_stop_words

    assert list(english_stop_words()) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_entry_imports_with_no_jar_visible():
    code = (
        "import glob, zipfile\n"
        "glob.glob = lambda *a, **k: []\n"
        "def gone(*a, **k): raise OSError('no jar')\n"
        "zipfile.ZipFile.__init__ = gone\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 36 and len(e.oracle_sql()) >= 30\n"
    )
    r = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True)
    assert r.returncode == 0, r.stderr
