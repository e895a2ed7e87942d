"""Text in one consistent form: strings that look alike become equal.

DuckDB runs inside the Arrow partitions: each batch is one query of nfc_normalize, translate and regular expressions.
What is changed, in this order:

1. invisible characters (zero width, joining, direction, selectors, soft hyphen, byte-order mark) go;
2. spaces other than U+0020 become U+0020;
3. width and joined presentation forms, and styled letters, become the ordinary letters, digits or signs;
4. canonical composition (NFC), which also replaces singletons such as the Kelvin sign;
5. letters of a foreign alphabet inside a word become the letter of the word's own alphabet that they look like, and
   phonetic or palochka-like variants inside an ordinary word become the ordinary letter.

Line feeds, tabs, repeated blanks, typographic quotes and dashes, ellipsis, superscripts, fractions, signs such as the
degree, trade-mark or numero sign, and words wholly in another alphabet stay as they are. Null stays null, the empty
text stays empty.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters without a shape of their own, as ranges.
INVISIBLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF9, 0xFFFB),
    (0xE0000, 0xE007F), (0xE0100, 0xE01EF),
)
# The decomposition tags of width, joined and styled forms.
FORM_TAGS = ("<wide>", "<narrow>", "<small>", "<vertical>", "<initial>", "<medial>", "<final>", "<isolated>", "<font>")
# Ranges whose <compat> letters are joined forms (ligatures, digraphs).
JOINED = ((0x0132, 0x0133), (0x0149, 0x0149), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0xFB00, 0xFB4F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC))
# What each foreign letter looks like among the Latin ones, by alphabet.
LATIN_LOOKS = {
    "Cyrillic": dict(zip("АВЕЅІЈКМНОРСТУХҮԌԚԜӀавеѕіјкмнорстухүһԁԛԝӏгп", "ABESIJKMHOPCTYXYGQWIabesijkmhopctyxyhdqwlrn", strict=True)),
    "Greek": dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳανοορυιχκτϲε", "ABEZHIKMNOPTYXCjavoopuixktce", strict=True)),
    "Armenian": dict(zip("ՍՕՏԼսօոհզցյքւ", "UOSLuonhqgjpi", strict=True)),
    "Cherokee": dict(zip("ᎪᎳᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "AWEHJKLMPRSTVWZ", strict=True)),
}
# Small letters that only resemble the Latin one (its small capital or italic form). They stand for it in a Latin word, but a Latin letter doesn't stand for them.
RESEMBLING = "вкмнтгпεκτϲ"
# Latin letters that are not the ordinary ones, and those they look like.
LATIN_VARIANTS = dict(zip("ɑɡſȷɩʏɪʟɴʀꞬꞮ", "agsjiyilnrgi", strict=True))


def _chars(ranges: tuple[tuple[int, int], ...]) -> Iterator[str]:
    for first, last in ranges:
        yield from map(chr, range(first, last + 1))


@lru_cache
def form_map() -> dict[str, str]:
    """Every width, joined or styled form and the ordinary characters for it, by rule from the Unicode data."""
    joined, out = set(_chars(JOINED)), {}
    for code in range(0x80, 0x1F000):
        if 0xAC00 <= code <= 0xDFFF or 0x3400 <= code <= 0x9FFF:
            continue
        ch = chr(code)
        tag, *rest = unicodedata.decomposition(ch).split() or [""]
        kind = unicodedata.category(ch)
        if kind == "Zs" or not rest:
            continue
        if tag in FORM_TAGS or tag == "<compat>" and ch in joined:
            plain = unicodedata.normalize("NFKC", ch)
            if 0x2000 <= code < 0x2E80 and kind[0] not in "LN":  # letter-like signs stay signs
                continue
            out[ch] = plain
    return out


@lru_cache
def space_chars() -> str:
    return "".join(c for c in map(chr, range(0x80, 0x3100)) if unicodedata.category(c) == "Zs")


def _accented(pairs: dict[str, str]) -> dict[str, str]:
    """The pairs, and each composed letter over a letter of them whose look-alike takes the same accents."""
    out = dict(pairs)
    for code in range(0x370, 0x530):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in pairs and len(whole := unicodedata.normalize("NFC", pairs[parts[0]] + parts[1:])) == 1:
            out.setdefault(chr(code), whole)
    return out


@lru_cache
def look_maps() -> dict[str, dict[str, str]]:
    """For each own alphabet of a word, the foreign letters and what they stand for in it."""
    latin: dict[str, str] = {}
    for pairs in LATIN_LOOKS.values():
        latin |= _accented(pairs)
    back = {k: {look: ch for ch, look in reversed(LATIN_LOOKS[k].items()) if ch not in RESEMBLING} for k in ("Cyrillic", "Greek")}
    cyrillic = back["Cyrillic"] | {ch: back["Cyrillic"][look] for ch, look in LATIN_LOOKS["Greek"].items() if look in back["Cyrillic"]}
    greek = back["Greek"] | {ch: back["Greek"][look] for ch, look in LATIN_LOOKS["Cyrillic"].items() if look in back["Greek"]}
    accented = {}
    for code in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFD", chr(code))
        for target in (cyrillic, greek):
            if len(parts) > 1 and parts[0] in target and len(whole := unicodedata.normalize("NFC", target[parts[0]] + parts[1:])) == 1:
                accented.setdefault(id(target), {})[chr(code)] = whole
    return {"Latin": latin, "Cyrillic": cyrillic | accented.get(id(cyrillic), {}), "Greek": greek | accented.get(id(greek), {})}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _translate(sql: str, pairs: dict[str, str]) -> str:
    return f"translate({sql}, {_text(''.join(pairs))}, {_text(''.join(pairs.values()))})"


def _class(chars: str | dict) -> str:
    """A regular-expression class of the characters, as ranges."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in out) + "]"


_LATIN = "A-Za-z\\x{C0}-\\x{24F}\\x{1E00}-\\x{1EFF}\\pM"


def _word(w: str, text: str) -> str:
    """A word of letters of several alphabets turns to the one in which all of them can stand. Where both Latin and another can be, it is Latin if at least half of the whole text's letters are. An ordinary Latin word loses its odd variants."""
    looks = look_maps()
    to_latin = looks["Latin"] | LATIN_VARIANTS
    has = lambda s: f"regexp_matches({w}, '\\p{{{s}}}')"
    fits = lambda own, pairs: f"regexp_full_match({w}, {_text(f'[{own}' + _class(pairs)[1:] + '+')})"
    other = {s: f"({has(s)} AND {fits(f'\\p{{{s}}}\\pM', looks[s])})" for s in ("Cyrillic", "Greek")}
    latin = f"{has('Latin')} AND {fits(_LATIN, to_latin)}"
    mostly = f"2 * length(regexp_replace({text}, '[^\\p{{Latin}}]', '', 'g')) >= length(regexp_replace({text}, '[^\\pL]', '', 'g'))"
    foreign = "[" + "".join(f"\\p{{{s}}}" for s in LATIN_LOOKS) + "]"
    branches = [
        f"WHEN NOT regexp_matches({w}, {_text(foreign)}) THEN CASE WHEN {latin} THEN {_translate(w, LATIN_VARIANTS)} ELSE {w} END",
        f"WHEN NOT {has('Latin')} AND NOT (regexp_matches({w}, '\\p{{Cyrillic}}') AND regexp_matches({w}, '\\p{{Greek}}')) THEN {w}",
        f"WHEN {latin} AND (NOT ({' OR '.join(other.values())}) OR {mostly}) THEN {_translate(w, to_latin)}",
        *[f"WHEN {other[s]} THEN {_translate(w, looks[s])}" for s in other],
    ]
    return "CASE " + " ".join(branches) + f" ELSE {w} END"


@lru_cache
def steps() -> tuple[str, ...]:
    """The DuckDB expressions over x, one after the other."""
    forms = form_map()
    single = {k: v for k, v in forms.items() if len(v) == 1}
    wide = {k: v for k, v in single.items() if 0xFF00 <= ord(k) <= 0xFF5E}
    rare = {k: v for k, v in single.items() if k not in wide}
    ligatures = {k: v for k, v in forms.items() if len(v) > 1 and 0xFB00 <= ord(k) <= 0xFB06}
    several = {k: v for k, v in forms.items() if len(v) > 1 and k not in ligatures}
    invisible = _class("".join(_chars(INVISIBLE)))
    spaces = _class(space_chars())
    pulled = "x"
    for form, plain in ligatures.items():
        pulled = f"replace({pulled}, {_text(form)}, {_text(plain)})"
    table = "MAP {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in several.items()) + "}"
    when = lambda chars, then: f"CASE WHEN regexp_matches(x, {_text(chars)}) THEN {then} ELSE x END"
    return (
        when(invisible, f"regexp_replace(x, {_text(invisible + '+')}, '', 'g')"),
        when(spaces, f"regexp_replace(x, {_text(spaces)}, ' ', 'g')"),
        when(_class(wide), _translate("x", wide)),
        when(_class(ligatures), pulled),
        when(_class(rare), _translate("x", rare)),
        when(_class(several), f"array_to_string(list_transform(string_split(x, ''), lambda c: coalesce({table}[c], c)), '')"),
        "nfc_normalize(x)",
        when(_class({**look_maps()["Latin"], **LATIN_VARIANTS}), f"array_to_string(list_transform(regexp_extract_all(x, '[\\pL\\pM]+|[^\\pL\\pM]+'), lambda w: {_word('w', 'x')}), '')"),
    )


def consistent_sql(source: str, column: str, result: str) -> str:
    """SELECT of all columns of the source and the consistent form of a text column. Only rows with other than ASCII characters pass through the steps."""
    chain = [f"s0 AS (SELECT *, {column} AS x FROM {source} WHERE length({column}) <> strlen({column}))"]
    chain += [f"s{i} AS (SELECT * REPLACE ({step} AS x) FROM s{i - 1})" for i, step in enumerate(steps(), 1)]
    plain = f"SELECT *, {column} AS x FROM {source} WHERE {column} IS NULL OR length({column}) = strlen({column})"
    return f"WITH {', '.join(chain)} SELECT * RENAME (x AS {result}) FROM (SELECT * FROM s{len(steps())} UNION ALL {plain})"


def duck_batches(batches: Iterator[pa.RecordBatch], sql: str, schema: pa.Schema, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Runs the query over each batch, as table 'batch', in an in-process DuckDB of one thread."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1})
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            con.register("batch", pa.Table.from_batches([batch.slice(at, rows)]))
            yield from con.sql(sql).to_arrow_table().cast(schema).to_batches()
            con.unregister("batch")


def consistent_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each row of the frame: key, text, consistent (string), changed (boolean, false for null).

    Nulls stay null, empty texts empty; texts of any length are handled whole; repeated keys give repeated rows. Columns
    of the frame other than these two are left out, so no name can clash.
    """
    kind = df.schema[key].dataType
    out = T.StructType([T.StructField("key", kind), T.StructField("text", T.StringType()), T.StructField("consistent", T.StringType()), T.StructField("changed", T.BooleanType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    sql = f"SELECT key, text, consistent, coalesce(consistent <> text, false) AS changed FROM ({consistent_sql('batch', 'text', 'consistent')})"
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(lambda it: duck_batches(it, sql, schema), out)


def changed_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text, consistent of the rows whose text is not in its consistent form. Texts of ASCII only are in it by definition and don't leave the JVM."""
    return consistent_texts(df.where(F.length(text) != F.octet_length(text)), key, text).where("changed").drop("changed")
