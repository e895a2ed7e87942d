import unicodedata

import pytest

from spoolwright.llm import consistent

CHANGED = {
    "ｆｏｕｒ ２": "four 2", "oﬃce": "office", "ﾊﾝ": "ハン", "cafe\u0301": "café", "5 \u212a": "5 K", "a\u200bb\u00ad\ufeff": "ab", "a\u00a0b\u3000c\u2009d": "a b c d", "pаper": "paper", "Аlоne": "Alone",
    "rіɡht": "right", "ɑt": "at", "мeдлeннo": "медленно", "κaλός": "καλός", "beetӏes": "beetles", "nսmbered": "numbered", "𝐛𝐨𝐥𝐝": "bold", "️ok": "ok", "ﻼ": "لا", "ëxё": "ëxë",
    # a word that can be of two alphabets is of that of the text
    "beside the аttіс in row 2": "beside the attic in row 2", "mеrсі": "merci", "that Кіkаn lifted": "that Kikan lifted", "hat Каmеl gelbe": "hat Kamel gelbe", "Утром \u0422o\u0440\u0441op обменял": "Утром Торсор обменял", "στο κoντα μετα": "στο κοντα μετα",
}
KEPT = ["", "plain", "a\nb\tc  d", "“quoted” – it’s… 10³ m² ½ 21 °C ACME™ № 5", "λόγος мир", "naïve façade Straße", "один two три", "ʃəɡ", "ı̇", "नमस्ते", "e=mc²", "Ωmega"]


@pytest.fixture(scope="module")
def got(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*CHANGED, *KEPT])] + [(None, None, "clash"), (7, "x\u200b" * 50_000, "clash")]
    df = spark.createDataFrame(rows, "k int, t string, consistent string")
    return {r.text: r for r in consistent.consistent_texts(df, "k", "t").collect()}, consistent.changed_texts(df, "k", "t").collect()


def test_changed(got):
    assert {t: got[0][t].consistent for t in CHANGED} == CHANGED
    assert {r.text for r in got[1]} == {*CHANGED, "x\u200b" * 50_000}


def test_kept(got):
    assert [t for t in KEPT if got[0][t].consistent != t and unicodedata.normalize("NFC", t) == t] == []


def test_null_and_long(got):
    assert got[0][None].consistent is None and got[0][None].changed is False
    assert got[0]["x\u200b" * 50_000].consistent == "x" * 50_000


def test_once_is_enough(spark, got):
    again = spark.createDataFrame([(i, r.consistent) for i, r in enumerate(got[0].values())], "k int, t string")
    assert consistent.changed_texts(again, "k", "t").count() == 0


def test_empty(spark):
    assert consistent.consistent_texts(spark.createDataFrame([], "k int, t string"), "k", "t").collect() == []
