"""Odd rows and foreign columns: every operator gives the same rows with columns named like its own, and a row for every row."""

import collections

import pytest
from pyspark.sql import functions as F

from kindred.llm import decontaminate, html_extract, licenses, merkle_manifest, near_dups, pii, substring_dups, token_alignment, url_filter

LONG = "call +49 30 1234567 or write to a.b@example.org now " * 4000
TEXTS = [
    None, "", " \n\t", "word", LONG, LONG, "mail x@y.zz and GNU General Public License v3", "mail x@y.zz and GNU General Public License v3",
    "4111 1111 1111 1111 or 10.0.0.1", "é 😀 ü", "the question number one of thirteen words stands here in full length today ok",
]
NAMES = "_key _text _hash _row _hits _items _words n node bands word base spans rank anchors repeated pairs times group leaf changed steps pos of block".split()


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i if i % 4 else None, t, "en", "src", 1) for i, t in enumerate(TEXTS)] + [(3, "word", "en", "src", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pages = spark.createDataFrame(
        [(i, u, h) for i, (u, h) in enumerate([
            (None, None), ("", ""), ("http://a.b/c", "<p>One</p>"), ("http://a.b/c", "<p>One</p>"), ("http://x.y/" + "z" * 100_000, "<article><p>" + "long " * 50_000),
            ("http://é.ü/ß?q", "<b"), ("nothing", "<script>"),
        ])] + [(2, "http://a.b/c", "<p>One</p>")] * 2, "page_id long, url string, html string")
    bench = spark.createDataFrame([(1, TEXTS[-1]), (2, None)], "item_id long, text string")
    return docs, pages, bench


def with_foreign(table):
    """Columns of all kinds under names that the operators use inside."""
    kinds = [F.lit(1), F.lit("x"), F.array(F.lit(1)), F.lit(True), F.lit(None).cast("binary")]
    return table.withColumns({name: kinds[i % len(kinds)] for i, name in enumerate(NAMES)})


OPERATORS = {
    "pii": lambda docs, pages, bench: pii.digest(pii.detect(docs)),
    "html": lambda docs, pages, bench: html_extract.extract(pages),
    "url": lambda docs, pages, bench: url_filter.judge(pages, url_filter.fit(url_filter.labelled(pages.sparkSession))),
    "near_dups": lambda docs, pages, bench: near_dups.groups(docs),
    "licenses": lambda docs, pages, bench: licenses.digest(licenses.scan(docs)),
    "decontaminate": lambda docs, pages, bench: decontaminate.check(docs, bench),
    "substrings": lambda docs, pages, bench: substring_dups.repeats(docs),
    "manifest": lambda docs, pages, bench: merkle_manifest.checked(merkle_manifest.manifest(docs)),
    "tokens": lambda docs, pages, bench: token_alignment.score(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_foreign_columns_and_repeated_rows(tables, name):
    docs, pages, bench = tables
    plain = collections.Counter(map(str, OPERATORS[name](docs, pages, bench).collect()))
    crowded = OPERATORS[name](with_foreign(docs), with_foreign(pages), with_foreign(bench)).collect()
    assert collections.Counter(map(str, crowded)) == plain
    rows = pages if name in ("html", "url") else docs
    assert sum(plain.values()) == rows.count()
    # Equal rows have equal results: three or four of them.
    assert max(plain.values()) >= 3


def test_deduplicated_keeps_foreign_columns(tables):
    docs, _, _ = tables
    crowded = with_foreign(docs)
    kept = near_dups.deduplicated(crowded)
    assert kept.columns == crowded.columns and kept.dtypes == crowded.dtypes
    assert kept.count() == near_dups.deduplicated(docs).count()
