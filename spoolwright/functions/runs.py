"""Run names: nine ordered key-value tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens of a run name in order, and the short forms of their values.
TOKENS = ("kind", "stage", "base", "method", "adapter", "quant", "ctx", "rows", "id")
ALIASES = {"finetune": "ft", "evaluation": "eval", "training": "train", "none": "na", "full": "full"}


def token(text: Column) -> Column:
    """Lower case with '-' for anything else than letters, digits and dots; 'na' for nothing."""
    clean = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[^a-z0-9.]+", "-"), "^-+|-+$", "")
    short = clean
    for name, alias in ALIASES.items():
        short = F.when(clean == name, F.lit(alias)).otherwise(short)
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("na"))


def run_name(**values: Column) -> Column:
    """kind-x__stage-y__...; tokens that aren't given are 'na'."""
    return F.concat_ws("__", *[F.concat(F.lit(f"{t}-"), token(values.get(t, F.lit(None).cast("string")))) for t in TOKENS])


def parsed(name: Column) -> Column:
    """Struct of the nine values, null unless all are there in order."""
    pattern = "^" + "__".join(rf"{t}-(.+?)" for t in TOKENS) + "$"
    return F.when(name.rlike(pattern), F.struct(*[F.regexp_extract(name, pattern, i).alias(t) for i, t in enumerate(TOKENS, 1)]))


def run_kind(checkpoints: Column, predictions: Column, manifests: Column) -> Column:
    """What a run folder is, by the counts of what lies in it."""
    return F.when(checkpoints > 0, "train").when(predictions > 0, "eval").when(manifests > 0, "data").otherwise("unknown")


def latest_epoch(names: Column) -> Column:
    """The greatest epoch or checkpoint number in an array of names; null without one."""
    number = lambda n: F.regexp_extract(n, r"(?:epoch|checkpoint)[_\-]?(\d+)", 1)
    return F.array_max(F.transform(F.filter(names, lambda n: number(n) != ""), lambda n: number(n).cast("int")))
