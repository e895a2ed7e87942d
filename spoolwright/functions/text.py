"""Text normalisers, predicates and renderings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens, typographic signs and what stands for them, the trivial segment texts.
SILENCE_TOKENS = ("<|nospeech|>", "<|nocaptions|>")
SMART_SIGNS = {"‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "–": "-", "—": "-", "…": "...", " ": " "}
USELESS_TEXTS = ("", ".", "…")
TRUE_WORDS = ("1", "true", "t", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "f", "no", "n", "off")
# Punctuation that counts as English text, and the ranges of scripts that don't.
ENGLISH_SIGNS = r".,!?;:'\"()\-"
FOREIGN_RANGES = r"ऀ-ॿ؀-ۿ一-鿿぀-ヿЀ-ӿ฀-๿"
# Number words and their values.
UNITS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())} | {"oh": 0}
TENS = {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
SCALES = {"thousand": 10**3, "million": 10**6, "billion": 10**9}


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))


def first_text(*texts: Column) -> Column:
    """The first that isn't null or blank, trimmed."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


def collapsed(text: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def phrase_key(text: Column) -> Column:
    """Lower case, anything but letters, digits and underscores as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def asr_key(text: Column) -> Column:
    """Lower case, typographic apostrophe plain, only a-z, 0-9 and apostrophes kept: the form in which transcripts are compared."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), "[‘’]", "'"), r"[^a-z0-9\s']+", " "), r"\s+", " "))


def without_odd_signs(text: Column) -> Column:
    """Typographic signs plain, control and format characters removed, white space collapsed."""
    for sign, plain in SMART_SIGNS.items():
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return collapsed(F.regexp_replace(text, r"[\p{Cc}\p{Cf}]", ""))


def odd_characters(text: Column, strict: bool = False) -> Column:
    """The characters that are no letters, marks, digits, punctuation or blanks, in order; strict: all but printable ASCII and line breaks."""
    allowed = r"\x20-\x7E\r\n\t" if strict else r"\p{L}\p{M}\p{N}\p{P}\p{Z}\r\n\t$+<=>^`|~"
    return F.regexp_extract_all(text, F.lit(f"([^{allowed}])"), 1)


def key_words(text: Column) -> Column:
    """Lower-case words of a-z, 0-9 and hyphens."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9\-]+"), lambda w: w != "")


def english_share(text: Column) -> Column:
    """Part of the trimmed text's characters that are a-z, 0-9 or common punctuation; blanks count in the whole only. Null for no text."""
    t = F.lower(F.trim(text))
    return F.length(F.regexp_replace(t, rf"[^a-z0-9{ENGLISH_SIGNS}]", "")) / F.nullif(F.length(t), F.lit(0))


def foreign_share(text: Column) -> Column:
    """Part of the trimmed text's characters that aren't ASCII."""
    t = F.lower(F.trim(text))
    return F.length(F.regexp_replace(t, r"[\x00-\x7F]", "")) / F.nullif(F.length(t), F.lit(0))


def is_english(text: Column, least: float = 0.7, most_foreign: float = 0.3) -> Column:
    """False for null and blank texts."""
    return F.coalesce((english_share(text) >= least) & (foreign_share(text) <= most_foreign) & ~text.rlike(f"[{FOREIGN_RANGES}]"), F.lit(False))


def has_silence_token(text: Column) -> Column:
    return F.coalesce(text.contains(SILENCE_TOKENS[0]) | text.contains(SILENCE_TOKENS[1]), F.lit(False))


def is_trivial(text: Column, phrases: list[str], patterns: list[str]) -> Column:
    """Whether the phrase key is one of the phrases or matches a pattern as a whole; false for an empty key."""
    key = phrase_key(text)
    hit = key.isin(phrases)
    for p in patterns:
        hit = hit | key.rlike(f"^(?:{p})$")
    return F.coalesce((key != "") & hit, F.lit(False))


def flag(text: Column, default: bool = False) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(default)


def float_list(text: Column) -> Column:
    """Numbers between blanks, commas or semicolons; what is none is left out."""
    return F.filter(F.transform(F.split(text, r"[\s,;]+"), lambda x: x.try_cast("double")), lambda x: x.isNotNull())


def slug(text: Column, limit: int = 64) -> Column:
    """Letters, digits, '.', '-' and '_' only, runs joined; what is longer than the limit ends in eight digits of its hash."""
    s = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._\-]+", "_"), r"_{2,}", "_")
    s = F.regexp_replace(s, r"^[_.\-]+|[_.\-]+$", "")
    s = F.coalesce(F.nullif(s, F.lit("")), F.lit("fallback"))
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.substring(s, 1, limit - 9), F.lit("_"), F.substring(F.sha1(text), 1, 8)))


def short_model_name(path: Column, limit: int = 28) -> Column:
    """Last component with invalid characters as '_', its middle cut out above the limit."""
    name = F.regexp_replace(F.element_at(F.split(F.regexp_replace(path, r"[\\/]+$", ""), r"[\\/]"), -1), r"[^A-Za-z0-9._\-]+", "_")
    half = (limit - 1) // 2
    return F.when(F.length(name) <= limit, name).otherwise(F.concat(F.substring(name, 1, half), F.lit("…"), F.right(name, F.lit(half))))


def _clock(seconds: Column, per: int) -> tuple[Column, Column]:
    units = F.bround(seconds * per).cast("long")
    return F.floor(units / per), F.pmod(units, F.lit(per))


def vtt_time(seconds: Column) -> Column:
    """hh:mm:ss.mmm, rounded half to even."""
    whole, rest = _clock(seconds, 1000)
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(whole / 3600), F.floor(F.pmod(whole, F.lit(3600)) / 60), F.pmod(whole, F.lit(60)), rest)


def ass_time(seconds: Column) -> Column:
    """h:mm:ss.cc, rounded half to even."""
    whole, rest = _clock(seconds, 100)
    return F.format_string("%d:%02d:%02d.%02d", F.floor(whole / 3600), F.floor(F.pmod(whole, F.lit(3600)) / 60), F.pmod(whole, F.lit(60)), rest)


def ass_text(text: Column) -> Column:
    for sign, kept in (("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ("\n", "\\N")):
        text = F.replace(text, F.lit(sign), F.lit(kept))
    return text


def prompt(prefix: str, text: Column, most: int) -> Column:
    return F.trim(F.concat_ws(" ", F.lit(prefix), F.substring(text, 1, most)))


_WIDE = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _number_pattern() -> str:
    """A run of number words between word boundaries, with blanks, commas and hyphens between them; 'and' may follow but not begin."""
    first = sorted([*UNITS, *TENS, "hundred", *SCALES], key=len, reverse=True)
    edge = lambda ahead: rf"(?{'' if ahead else '<'}![\p{{L}}\p{{M}}\p{{N}}_])"
    word = lambda words: f"{edge(False)}(?:{'|'.join(words)}){edge(True)}"
    return rf"(?iu){word(first)}(?:[{_WIDE},\-]+{word([*first, 'and'])})*"


def _number_value(run: Column) -> Column:
    """Digits one by one are put side by side; anything else is added up, scales multiply what is before them."""
    words = F.regexp_extract_all(F.lower(run), F.lit(r"(\p{L}+)"), 1)
    table = lambda pairs: F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    digits, plain, scales = table({w: n for w, n in UNITS.items() if n < 10}), table(UNITS | TENS), table(SCALES)
    long = lambda x: F.lit(x).cast("long")

    def step(acc: Column, w: Column) -> Column:
        total, part = acc["total"], acc["part"]
        return (
            F.when(w == "and", acc)
            .when(w == "hundred", F.struct(total.alias("total"), (F.greatest(part, long(1)) * 100).alias("part")))
            .when(F.map_contains_key(scales, w), F.struct((total + F.greatest(part, long(1)) * scales[w]).alias("total"), long(0).alias("part")))
            .otherwise(F.struct(total.alias("total"), (part + F.coalesce(plain[w], F.lit(0))).cast("long").alias("part")))
        )

    added = F.aggregate(words, F.struct(long(0).alias("total"), long(0).alias("part")), step, lambda acc: (acc["total"] + acc["part"]).cast("string"))
    return F.when(F.forall(words, lambda w: F.map_contains_key(digits, w)), F.array_join(F.transform(words, lambda w: digits[w].cast("string")), "")).otherwise(added)


def number_words(text: Column) -> Column:
    """Runs of number words as digits; all else, white space included, stays. A run that ends in 'and' takes it along. Sums stay exact up to 2^63."""
    pattern = _number_pattern()
    runs = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    between = F.split(text, pattern, -1)
    pieces = F.zip_with(between, F.transform(runs, _number_value), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(pieces, "")).otherwise(text)
