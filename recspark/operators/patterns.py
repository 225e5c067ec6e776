"""Many name patterns against many names, without testing every pair.

A regular expression that matches a name must find its literal parts in it.  Per pattern one trigram of its longest literal run is
chosen, the one that the fewest names have; names and patterns meet by equi-join on trigrams, and only these pairs are tested with
the expression.  The result is exact: a literal run counts only where every match must contain it (outside groups, classes and
alternatives, without an optional quantifier behind it).

Patterns without such a run of three characters are tested against all distinct names: by a broadcast of these patterns while
they are few (counted), else in blocks of them.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.operators.candidates import blocked_join
from recspark.session import materialize

ship_by_value(__name__)

GRAM = 3
BLOCK = 2000  # patterns without a literal that travel in one broadcast
_PLAIN = re.compile(r"[A-Za-z0-9 _'&,/#-]")


def literal_runs(pattern: str) -> list[str]:
    """Strings that every match of a regular expression contains; an empty list if none is certain.

    Knows single characters, escaped punctuation, ``.``, anchors and quantifiers; of anything else (groups, classes,
    alternatives, flags) it claims nothing.
    """
    if re.search(r"[|()\[\]]|\\[^\W_]|\\Q", pattern):
        return []
    runs, run, at = [], "", 0
    while at < len(pattern):
        c, width = pattern[at], 1
        if c == "\\" and at + 1 < len(pattern):
            c, width, known = pattern[at + 1], 2, True
        else:
            known = bool(_PLAIN.fullmatch(c))
        behind = pattern[at + width:at + width + 1]
        if known and behind not in ("?", "*", "{"):
            run += c
            if behind == "+":  # once more or many times: the run ends here
                runs, run = [*runs, run], ""
        else:
            runs, run = [*runs, run], ""
        at += width
        if behind == "{":
            at = pattern.find("}", at) + 1 or len(pattern)
        elif behind and behind in "?*+":
            at += 1
            at += pattern[at:at + 1] in ("?", "+")  # lazy or possessive
    return [r for r in [*runs, run] if r]


def _grams(batches):
    for batch in batches:
        rows = []
        for pattern in batch["pattern"]:
            run = max(literal_runs(pattern), key=len, default="")
            rows += [(pattern, run[k:k + GRAM]) for k in range(len(run) - GRAM + 1)] or [(pattern, None)]
        yield pd.DataFrame(rows, columns=["pattern", "gram"])


def matches(name, pattern, prefix):
    """Whether a name matches: anchored at its start where ``prefix``, else anywhere."""
    anchored = F.concat(F.lit("^(?:"), pattern, F.lit(")"))
    return F.when(prefix, F.regexp_like(name, anchored)).otherwise(F.regexp_like(name, pattern))


def pattern_names(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, match, name) for every distinct name that matches a pattern; ``names`` (name), ``patterns`` (pattern, match)."""
    names = materialize(names.select("name").where("name IS NOT NULL").distinct(), "distinct-names")
    patterns = materialize(patterns.select("pattern", "match").where("pattern IS NOT NULL").distinct(), "patterns")
    places = F.sequence(F.lit(1), F.length("name") - (GRAM - 1))
    grams = names.where(F.length("name") >= GRAM).select(
        "name", F.explode(F.array_distinct(F.transform(places, lambda k: F.substring("name", k, GRAM)))).alias("gram"))
    asked = materialize(patterns.select("pattern").distinct().mapInPandas(_grams, "pattern string, gram string"), "pattern-grams")
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a gram that no name has rules its pattern out
    rarest = (asked.where("gram IS NOT NULL").join(held, "gram", "left").groupBy("pattern")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")).where("best.n > 0")
              .select("pattern", F.col("best.gram").alias("gram")))
    indexed = patterns.join(rarest, "pattern")
    test = matches(F.col("name"), F.col("pattern"), F.col("match"))
    found = [blocked_join(grams, indexed, ["gram"]).where(test).select("pattern", "match", "name")]
    loose = patterns.join(asked.where("gram IS NULL").select("pattern"), "pattern", "left_semi")
    blocks = -(-loose.count() // BLOCK)
    for k in range(blocks):
        block = loose if blocks == 1 else loose.where(F.pmod(F.xxhash64("pattern", "match"), F.lit(blocks)) == k)
        found.append(names.join(F.broadcast(block), test).select("pattern", "match", "name"))
    return reduce(lambda a, b: a.unionByName(b), found)
