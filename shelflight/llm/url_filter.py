"""URL filter: given rules first, then association rules mined from the URLs that those rules label.

A given rule is a host and a path start; it fits its host and all subdomains, and the longest fitting rule
decides.  The URLs that a rule decides are the labelled ones.  FP-growth mines combinations of their tokens
together with the label.  A combination that implies a label with enough support and confidence becomes a rule,
unless a part of it implies the same label at least as surely.  The rules are matched by an inverted index:
each stands under one of its tokens, a URL looks up its own tokens and checks the rules that it finds.

A URL has one token of each kind: top-level domain, domain, host, first directory, first letter of what follows
it, depth, ending.  So a URL has at most seven tokens however long it is, and the mined rules number at most
2**7 / ``min_support``: the rule list is a model of bounded size, which every task may hold.

Null URLs and URLs without ``://`` have an empty host and path, no token and no rule, and are allowed, as is
every URL that no rule decides.  Without labelled URLs nothing is mined.  Of mined rules the surest decides, then
the one with more support, then more tokens, then blocking, then the lesser tokens.  Rows are judged one by one:
repeated rows stay, other columns are untouched unless they have the name of an output.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule) pairs of the standing lists.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.9
LABEL = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def standing_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct of size, rule, verdict; null if none fits."""
    found = []
    for verdict, rule in rules:
        of_host, slash, of_path = rule.partition("/")
        of_path = slash + of_path
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(of_path))
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"),
                                           F.lit(verdict).alias("verdict"))))
    if not found:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array(*found))


def tokens(host: Column, path: Column) -> Column:
    """The tokens of a URL, at most one of each kind."""
    parts = F.split(host, r"\.")
    directory = F.regexp_extract(path, r"^/([^/]+)/", 1)
    name = F.regexp_extract(path, r"^/[^/]+/(.)", 1)
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    depth = F.size(F.filter(F.split(path, "/"), lambda p: p != ""))

    def token(kind: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(kind + "="), value))

    kinds = [token("top", F.element_at(parts, -1)), token("domain", F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)))),
             token("host", host), token("directory", directory), token("lead", name),
             F.when(host != "", F.concat(F.lit("depth="), F.least(depth, F.lit(9)).cast("string"))), token("ending", ending)]
    return F.array_compact(F.array(*kinds))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules of rows with ``tokens`` and ``verdict``: ``antecedent, verdict, confidence, support``."""
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(LABEL)))
             .select(F.array_sort("antecedent").alias("antecedent"), F.substr(F.col("consequent")[0], F.lit(len(LABEL) + 1)).alias("verdict"),
                     "confidence", "support"))
    # A rule is pruned if leaving out one token gives a rule for the same verdict that is as sure.
    parts = (rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("without"))
             .select(F.col("antecedent").alias("whole"), F.col("verdict").alias("said"), F.col("confidence").alias("sure"),
                     F.array_remove("antecedent", F.col("without")).alias("part")))
    weaker = (parts.join(rules, (parts.part == rules.antecedent) & (parts.said == rules.verdict) & (rules.confidence >= parts.sure))
              .select(F.col("whole"), F.col("said")).distinct())
    return rules.join(weaker, (rules.antecedent == weaker.whole) & (rules.verdict == weaker.said), "left_anti")


def inverted_index(rules: DataFrame) -> Column | None:
    """The rules as a map from a token to the rules that stand under it; null without rules.

    Each rule stands under its token that fewest rules have, so look-ups find few.
    """
    rows = rules.collect()  # at most 2**7 / min_support rules
    if not rows:
        return None
    uses: dict[str, int] = {}
    for r in rows:
        for t in r["antecedent"]:
            uses[t] = uses.get(t, 0) + 1
    under: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["antecedent"], r["verdict"])):
        under.setdefault(min(r["antecedent"], key=lambda t: (uses[t], t)), []).append(r)
    kind = "struct<confidence:double,support:double,size:int,block:int,tokens:array<string>,verdict:string>"
    entries = []
    for t, found in sorted(under.items()):
        listed = [F.struct(F.lit(r["confidence"]), F.lit(r["support"]), F.lit(len(r["antecedent"])),
                           F.lit(int(r["verdict"] == "block")), F.array(*map(F.lit, r["antecedent"])), F.lit(r["verdict"])).cast(kind)
                  for r in found]
        entries += [F.lit(t), F.array(*listed)]
    return F.create_map(*entries)


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and ``mined``, the tokens of the mined rule that decided."""
    host, path = host_and_path(F.col(url))
    seen = (pages.withColumn("__url", F.struct(host.alias("host"), path.alias("path")))
            .withColumn("__rule", standing_rule(F.col("__url.host"), F.col("__url.path"), rules))
            .withColumn("__tokens", tokens(F.col("__url.host"), F.col("__url.path"))))
    labelled = seen.where("__rule IS NOT NULL").select(F.col("__tokens").alias("tokens"), F.col("__rule.verdict").alias("verdict"))
    index = inverted_index(mine(labelled, min_support, min_confidence)) if not labelled.isEmpty() else None
    if index is None:
        best = F.lit(None).cast("struct<verdict:string,tokens:array<string>>")
    else:
        found = F.flatten(F.transform("__tokens", lambda t: F.coalesce(F.try_element_at(index, t), F.array())))
        fitting = F.filter(found, lambda r: F.size(F.array_except(r["tokens"], F.col("__tokens"))) == 0)
        best = F.array_max(F.transform(fitting, lambda r: F.struct(
            r["confidence"].alias("confidence"), r["support"].alias("support"), r["size"].alias("size"), r["block"].alias("block"),
            r["tokens"].alias("tokens"), r["verdict"].alias("verdict"))))
    mined = F.when(F.col("__rule").isNull(), best)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "mined")]
    judged = seen.withColumn("__mined", mined)
    return judged.select(*(F.col(f"`{c}`") for c in kept), F.col("__url.host").alias("host"), F.col("__url.path").alias("path"),
                         F.col("__rule.rule").alias("rule"),
                         F.coalesce("__rule.verdict", "__mined.verdict", F.lit("allow")).alias("verdict"),
                         F.col("__mined.tokens").alias("mined"))
