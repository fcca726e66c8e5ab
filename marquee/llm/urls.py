"""URL filters: a rule list, and association rules mined from the urls it decides.

1. A url's host and path are matched against a list of rules (host and its
   subdomains, path prefix, longest rule wins).
2. The urls decided that way are labelled baskets of tokens.  Tokens that occur in
   exactly the same baskets form a class, and one of them stands for it, so item
   sets do not multiply over tokens that always go together.  Spark's FP-growth
   mines combinations of classes that go with a label; rules below the support and
   confidence limits are pruned.
3. Urls that no list rule decides are matched against the mined rules by an
   inverted index: a rule is filed under the tokens of its rarest class, so a url
   only meets rules that share a rare token with it, and the rest of the rule is
   checked on the url's own tokens.  A url has a class if it has any token of it:
   each of them would have given the same rule.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import lower_ascii, stored

# The rule list (verdict, host with path prefix).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Share of the labelled urls that a combination must occur in, and of these that must have its label.
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
#: Tokens of the longest combination.
MOST_TOKENS = 3
_LABEL = "label="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end.  Both are empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.substring_index(F.substring_index(rest, "?", 1), "#", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    return lower_ascii(host), F.substring(rest, F.length(host) + 1, F.length(rest))


def list_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the last that fits is the longest
        domain, _, prefix = r.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + prefix))
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, host and its labels, path steps
    (digits as one mark), extension, and names of query fields."""
    url = F.coalesce(url, F.lit(""))
    step = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    tagged = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("scheme:"), lower_ascii(F.substring_index(url, "://", 1))), F.concat(F.lit("host:"), host)),
        tagged("name:", F.filter(F.split(host, r"\."), lambda x: x != "")),
        tagged("step:", F.transform(steps, step)),
        tagged("field:", F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))))


def token_classes(labelled: DataFrame, least: float) -> DataFrame:
    """token, leader (the smallest token of its class) of the tokens in at least ``least`` of the baskets.

    Two tokens are of one class if they occur in the same baskets: as many, with
    the same sum of basket hashes (64 bits, exact).  There are no more rows than a
    basket has tokens on average, divided by ``least``."""
    rows = labelled.select("tokens", F.xxhash64(F.array_sort("tokens")).cast("decimal(20,0)").alias("basket"))
    counts = (rows.select(F.explode("tokens").alias("token"), "basket").groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("basket").alias("baskets")))
    total = labelled.agg(F.count(F.lit(1)).alias("total"))  # one row
    often = counts.join(F.broadcast(total), F.col("n") >= F.col("total") * F.lit(least)).drop("total")
    leaders = often.groupBy("n", "baskets").agg(F.min("token").alias("leader"))
    return often.join(leaders, ["n", "baskets"]).select("token", "leader")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, tokens, classes, verdict, confidence, support, index_tokens of the mined rules.

    ``labelled``: tokens (distinct in a row), verdict.  FP-growth runs on the
    leaders of the baskets' token classes with the label as one more token; rules
    kept are those whose consequent is a label.  tokens are the leaders of a rule,
    classes all tokens of each leader's class, in the same order.
    A combination that has no more confidence than a part of it with the same
    verdict is pruned.  Their number is bounded by the limits, not by the table."""
    classes = stored(token_classes(labelled, min_support), "url-token-classes")
    leaders = [r.leader for r in classes.select("leader").distinct().collect()]  # bounded, see token_classes
    kept = F.array_intersect("tokens", F.array(*map(F.lit, leaders)).cast("array<string>"))
    baskets = labelled.select(F.concat(kept, F.array(F.concat(F.lit(_LABEL), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(_LABEL)) & (F.size("antecedent") <= MOST_TOKENS)
                                          & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit(_LABEL))))
             .select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], len(_LABEL) + 1, 100).alias("verdict"),
                     "confidence", "support"))
    rules = stored(rules.withColumn("rule_id", F.xxhash64("tokens", "verdict")), "url-rules")
    # general rules with at least the confidence make a longer one superfluous
    shorter = rules.select(F.col("tokens").alias("t"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.explode("tokens").alias("token"))
    beaten = (rules.withColumn("token", F.explode("tokens")).join(shorter, "token")
              .where((F.col("verdict") == F.col("v")) & (F.size("t") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
                     & (F.size(F.array_except("t", "tokens")) == 0)).select("rule_id").distinct())
    kept = rules.join(beaten, "rule_id", "left_anti")
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("leader"), F.col("freq"))
    members = classes.groupBy("leader").agg(F.sort_array(F.collect_list("token")).alias("class")).join(counts, "leader")
    parts = (kept.select("rule_id", F.explode("tokens").alias("leader")).join(members, "leader").groupBy("rule_id")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("leader", "class"))), lambda x: x["class"]).alias("classes"),
                  F.min(F.struct("freq", "leader", "class"))["class"].alias("index_tokens")))
    return kept.join(parts, "rule_id")


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """row_key and its mined verdict: of the rules that fit, the one with the
    most confidence, then support, then tokens, then rule_id.  ``pages``: row_key, tokens."""
    index = rules.select("rule_id", "classes", "verdict", "confidence", "support", F.explode("index_tokens").alias("index_token"))
    return (pages.select("row_key", "tokens", F.explode("tokens").alias("index_token")).join(index, "index_token")
            .where(F.forall("classes", lambda c: F.arrays_overlap(c, F.col("tokens"))))
            .groupBy("row_key").agg(F.max_by("verdict", F.struct("confidence", "support", F.size("classes"), "rule_id")).alias("mined")))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    rule is the list rule that decides, else null and the mined rules decide;
    a url that no rule fits, a null url and one without ``://`` are allowed.
    Repeated rows and null ids are judged like any other; extra columns are
    ignored.  With no url that the list decides nothing is mined."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    split = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = list_rule(F.col("host"), F.col("path"), rules)
    judged = split.withColumn("rule", rule).withColumn("listed", verdict).withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    # equal urls are judged once, so a page that many rows repeat costs one
    urls = stored(judged.select(F.xxhash64("url").alias("row_key"), "url", "tokens", "listed").where("listed is null").dropDuplicates(["url"]), "urls")
    learned = mine_rules(judged.where("listed is not null").select("tokens", F.col("listed").alias("verdict")), min_support, min_confidence)
    mined = match_rules(urls.withColumn("row_key", F.col("url")), stored(learned, "url-rule-index"))
    return (judged.join(mined.withColumnRenamed("row_key", "__url"), F.col("url") == F.col("__url"), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit("allow")).alias("verdict")))
