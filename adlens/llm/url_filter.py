"""URL filter: rules by host and path, and a ratio of character language models for the rest.

Two variable-order Markov models are learnt from the URLs that rules accept and reject. Every context of up to
`ORDER` characters that was seen `LEAST_COUNT` times is kept. Probabilities are smoothed by interpolation with the
next shorter context (Witten-Bell). What a character adds to a score depends on it and the `ORDER` characters before
it alone, so the models are looked up once for each such gram and the values joined to the characters of the URLs;
they are broadcast only if there are few. Contexts of up to two characters, which the alphabet bounds to 5,000, are
always broadcast. A URL's score is the difference of its two log-likelihoods over its
length; the limit is the one that separates a held-out fifth of the ruled URLs best. Counts are of all
ruled URLs of the other four fifths. Only DataFrame functions are used; a URL that occurs often is
scored once.

Defined cases: a null URL is empty: host and path are empty, no rule fits, and the text scored is the end
sign alone; with no accepted or no rejected URL the score is 0 and the verdict `allow`; a score at the
limit is `allow`; repeated rows each get their row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.sources.materialise import materialise

ORDER = 4
LEAST_COUNT = 20
#: Grams whose values may be broadcast: some 16 MB.
FEW_GRAMS = 400_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER, END, START = "\x01", "\x02", "\x03"
#: Printable ASCII without upper case, any other character, and the end of the URL.
SYMBOLS = "".join(chr(c) for c in range(33, 127) if chr(c) not in UPPER) + OTHER + END


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(text: str) -> list[Rule]:
    """Rules such as `allow org/, block example.org/es/`."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        verdict, where = part.split()
        host, slash, path = where.partition("/")
        out.append(Rule(verdict, host, slash + path))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def _text(url: Column) -> Column:
    return F.regexp_replace(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), r"[^\x21-\x7e]", OTHER)


def _positions(texts: DataFrame) -> DataFrame:
    """A row for each character of `text` and its end: `symbol` (number) and `before` (the characters before it)."""
    padded = F.concat(F.lit(START * ORDER), F.col("text"), F.lit(END))
    rows = texts.withColumn("_padded", padded).withColumn("_i", F.explode(F.sequence(F.lit(1), F.length("text") + 1)))
    return rows.select(
        *texts.columns,
        F.instr(F.lit(SYMBOLS), F.substring(F.col("_padded"), F.col("_i") + ORDER, F.lit(1))).alias("symbol"),
        F.substring(F.col("_padded"), F.col("_i"), F.lit(ORDER)).alias("before"),
    )


def _counts(texts: DataFrame) -> DataFrame:
    """`context`, `accepted`, `rejected` (arrays of counts by symbol) of the contexts that are kept."""
    rows = _positions(texts).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(ORDER))))
    grams = materialise(
        rows.withColumn("context", F.substring(F.col("before"), F.lit(ORDER + 1) - F.col("_k"), F.col("_k")))
        .groupBy("context", "symbol")
        .agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")),
        "url-grams",
    )
    listed = (
        grams.groupBy("context")
        .agg(
            F.sum(F.col("a") + F.col("r")).alias("n"),
            F.collect_list(F.struct("symbol", "a", "r")).alias("_seen"),  # one entry for each symbol at most
        )
        .filter((F.col("n") >= LEAST_COUNT) | (F.col("context") == ""))
    )

    def dense(field: str) -> Column:
        seen = F.map_from_entries(F.transform("_seen", lambda s: F.struct(s["symbol"], s[field])))
        return F.transform(F.sequence(F.lit(1), F.lit(len(SYMBOLS))), lambda i: F.coalesce(F.element_at(seen, i), F.lit(0)).cast("double"))

    return listed.select("context", dense("a").alias("accepted"), dense("r").alias("rejected"))


def _smoothed(counts: Column, shorter: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, n: s + n)
    kinds = F.greatest(F.size(F.filter(counts, lambda n: n > 0)), F.lit(1)).cast("double")
    return F.zip_with(counts, shorter, lambda n, p: (n + kinds * p) / (total + kinds))


def fit_ratio(texts: DataFrame) -> DataFrame:
    """`context`, `ratio` (log of accepted over rejected probability by symbol) from `text`, `accepted`, `rejected` counts."""
    counts = materialise(_counts(texts), "url-counts")
    even = F.array_repeat(F.lit(1.0 / len(SYMBOLS)), len(SYMBOLS))
    level = counts.filter("context = ''").select(
        "context", _smoothed(F.col("accepted"), even).alias("pa"), _smoothed(F.col("rejected"), even).alias("pr")
    )
    levels = [materialise(level, "url-level")]
    for k in range(1, ORDER + 1):
        shorter = levels[-1].select(F.col("context").alias("_shorter"), F.col("pa").alias("_pa"), F.col("pr").alias("_pr"))
        longer = counts.filter(F.length("context") == k).join(shorter, F.substring("context", 2, k) == F.col("_shorter"))
        levels.append(
            materialise(
                longer.select(
                    "context",
                    _smoothed(F.col("accepted"), F.col("_pa")).alias("pa"),
                    _smoothed(F.col("rejected"), F.col("_pr")).alias("pr"),
                ),
                "url-level",
            )
        )
    model = levels[0]
    for level in levels[1:]:
        model = model.unionByName(level)
    return materialise(
        model.select("context", F.zip_with("pa", "pr", lambda a, r: F.log(a / r)).alias("ratio")), "url-model"
    )


def score_ratio(texts: DataFrame, model: DataFrame, few_grams: int = FEW_GRAMS) -> DataFrame:
    """`text`, `score` for every different text."""
    rows = _positions(texts.select("text").distinct())
    grams = rows.select("before", "symbol").distinct()
    for k in range(ORDER + 1):
        own = model.filter(F.length("context") == k).select(F.col("context").alias(f"_c{k}"), F.col("ratio").alias(f"_r{k}"))
        # The alphabet bounds contexts of up to two characters; longer ones are joined as their size allows.
        own = F.broadcast(own) if k <= 2 else own
        grams = grams.join(own, F.substring(F.col("before"), ORDER + 1 - k, k) == F.col(f"_c{k}"), "left").drop(f"_c{k}")
    ratio = F.coalesce(*[F.col(f"_r{k}") for k in reversed(range(ORDER + 1))])
    values = materialise(grams.select("before", "symbol", F.element_at(ratio, F.col("symbol")).alias("value")), "url-grams")
    # Written, so its size is known: broadcast if checked to be small, else Spark splits the rows of a frequent gram.
    values = F.broadcast(values) if values.count() <= few_grams else values
    return rows.join(values, ["before", "symbol"]).groupBy("text").agg(F.avg("value").alias("score"))


def calibrated_limit(scored: DataFrame) -> float:
    """The limit on `score` with the best mean of both classes' shares of right verdicts, midway to the next lower score.

    0 if a class is missing.
    """
    bins = scored.groupBy(F.round("score", 2).alias("at")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).filter("at BETWEEN -20 AND 20")
    # at most 4,001 bins
    best = bins.sparkSession.sql(
        """WITH t AS (SELECT at, sum(a) OVER w AS below_a, sum(r) OVER w AS below_r, a, r,
                 coalesce((at + lag(at) OVER (ORDER BY at)) / 2, at - 0.005D) AS mid, sum(a) OVER () AS all_a, sum(r) OVER () AS all_r FROM {bins}
                 WINDOW w AS (ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
           SELECT mid AS at, (all_a - below_a + a) / all_a + (below_r - r) / all_r AS right
           FROM t WHERE all_a > 0 AND all_r > 0 ORDER BY right DESC, abs(mid), mid LIMIT 1""",
        bins=bins,
    ).collect()
    return float(best[0]["at"]) if best else 0.0


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """`id`, `host`, `path`, `rule`, `verdict`, `score` (null where a rule decides) for every row of `pages`."""
    host, path = host_and_path(F.col("url"))
    by_length = sorted(rules, key=lambda r: -len(r.text))  # the longest fitting rule comes first
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(by_length):
        fits = _fits(rule, F.col("host"), F.col("path"))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    rows = materialise(
        pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": text, "ruled": verdict, "text": _text(F.col("url"))})
        .drop("url"),
        "urls",
    )
    ruled = rows.filter("ruled IS NOT NULL").groupBy("text").agg(
        F.count_if(F.col("ruled") == "allow").alias("accepted"), F.count_if(F.col("ruled") == "block").alias("rejected")
    )
    aside = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    totals = ruled.filter(~aside).agg(F.sum("accepted"), F.sum("rejected")).first()
    if not totals[0] or not totals[1]:
        return rows.select("id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.when(F.col("ruled").isNull(), F.lit(0.0)).alias("score"))
    model = fit_ratio(ruled.filter(~aside))
    limit = calibrated_limit(score_ratio(ruled.filter(aside), model).join(ruled.filter(aside), "text"))
    scores = score_ratio(rows.filter("ruled IS NULL"), model)
    decided = rows.filter("ruled IS NOT NULL").withColumn("score", F.lit(None).cast("double"))
    open_ = rows.filter("ruled IS NULL").join(scores, "text")
    judged = F.coalesce("ruled", F.when(F.col("score") >= limit, "allow").otherwise("block"))
    return decided.unionByName(open_, allowMissingColumns=True).select("id", "host", "path", "rule", judged.alias("verdict"), "score")
