"""Core queries that SQL can't say, against results that were looked through once on the smallest tables."""

import hashlib
import json
import os

import pytest

from spoolwright.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# rows, and a digest of the sorted rows with numbers to four places
GOLDEN = json.loads(open(os.path.join(os.path.dirname(__file__), "golden.json")).read())


def plain(x):
    if isinstance(x, float):
        return round(x, 4) + 0.0
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    if isinstance(x, dict):
        return sorted((k, plain(v)) for k, v in x.items())
    return x if x is None or isinstance(x, (int, str)) else str(x)


def digest(df):
    columns = sorted(df.columns)
    rows = sorted(json.dumps([plain(r[c]) for c in columns], ensure_ascii=False) for r in df.collect())
    return [len(rows), hashlib.sha256("\n".join([",".join(columns), *rows]).encode()).hexdigest()[:16]]


def test_no_query_is_without_a_check():
    assert sorted(GOLDEN) == sorted(set(catalog.queries()) - set(catalog.oracle_sql()))


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden(spark, name):
    assert digest(catalog.queries()[name](spark, SF)) == GOLDEN[name]
