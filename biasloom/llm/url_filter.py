"""URL filter: rules first, then two character language models.

Rules name a host and a path prefix; the longest rule that fits an address
decides. What no rule decides is judged by variable-order Markov models of the
accepted and of the rejected addresses, both trained on all that the rules decide:
the verdict is the length-normalised log-likelihood difference against a
threshold. That is calibrated on all labelled addresses too, in folds: each one is
scored by the counts less those of its own fold, that is by models that have not
seen it. A model is a table of character runs with their counts, smoothed from order to
order. Distinct runs are joined with it for each order; the characters of addresses, which
are many more, are shuffled once, to meet their runs' differences. No Python runs on the
executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch

#: (verdict, host and path prefix); a rule fits its host and all subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Longest context of a model.
ORDER = 4
#: Folds of the labelled addresses: a fold is scored by the counts of the others.
FOLDS = 5
VERDICTS = ("allow", "block")
#: What a shorter context counts for beside a longer one, and the characters
#: that an unseen one is taken to be one of.
BACKOFF = 2.0
CHARACTERS = 128.0
#: Bins of the calibration, over differences from -SPREAD to SPREAD.
BINS = 400
SPREAD = 4.0
SCHEME_END = "://"
#: Frame of an address.
START, END = "\u0002", "\u0003"


def address(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, SCHEME_END)
    rest = F.when(at > 0, F.substr(text, at + len(SCHEME_END))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule as (verdict, rule); null if none fits."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def _runs(urls: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
    """A row for each character: ``run`` is it and the ORDER characters before, fewer at the start.

    The address is framed, so that its start is a context.
    """
    framed = F.concat(F.lit(START), F.lower(text), F.lit(END))
    numbered = urls.select(*keep, framed.alias("uf__text"))
    at = F.explode(F.sequence(F.lit(2), F.length("uf__text")))
    rows = numbered.select(*keep, "uf__text", at.alias("uf__at"))
    start = F.greatest(F.lit(1), F.col("uf__at") - ORDER)
    run = F.substr("uf__text", start, F.col("uf__at") - start + 1)
    return rows.select(*keep, run.alias("run"))


def _shortened(runs: DataFrame, k: int) -> DataFrame:
    """The runs that reach so far, cut to their last k + 1 characters; repeats stay."""
    return runs.filter(F.length("run") > k).withColumn("run", F.substr("run", F.lit(-k - 1)))


def train(labelled: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """For each order, rows (run, allow, block): log-weights in both models.

    labelled has ``url`` and ``verdict``; whole addresses and all their runs
    count. A row holds, for each model, how often the run occurred and how often
    its context. If labelled has ``fold``, from 0 to FOLDS - 1, the row also has both
    numbers by fold, as arrays. The longest runs are counted; shorter ones are sums of these.
    """
    folds = "fold" in labelled.columns
    rows = _runs(labelled, F.col("url"), ["verdict", "fold"] if folds else ["verdict"])
    counts = {v: F.count_if(F.col("verdict") == v) for v in VERDICTS}
    parts = [(v, f"{v}_by_{f}", f) for v in VERDICTS for f in range(FOLDS if folds else 0)]
    for v, part, f in parts:
        counts[part] = F.count_if((F.col("verdict") == v) & (F.col("fold") == f))
    longest = rows.groupBy("run").agg(*(n.alias(c) for c, n in counts.items()))
    longest = scratch.keep(longest, "runs")
    orders = []
    for k in range(ORDER + 1):
        counted = _shortened(longest, k)
        if k < ORDER:
            counted = counted.groupBy("run").agg(*(F.sum(c).alias(c) for c in counts))
        context = F.substr("run", F.lit(1), F.lit(k)) if k else F.lit("")
        alike = Window.partitionBy("context")
        sums = {v: F.sum(v).over(alike) for v in counts}
        columns = ["run", "context", *VERDICTS, *(sums[v].alias(f"{v}_all") for v in VERDICTS)]
        for v in VERDICTS if folds else ():
            own = [part for of, part, _ in parts if of == v]
            columns.append(F.array(*own).alias(f"{v}_own"))
            columns.append(F.array(*(sums[part] for part in own)).alias(f"{v}_all_own"))
        counted = counted.withColumn("context", context).select(*columns)
        orders.append(scratch.keep(counted, f"order-{k}"))
    return orders


def _joined(left: DataFrame, right: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """A sort-merge join, however small the files of either side.

    Runs, counts by fold and addresses are many times their compressed files, and
    characters many times their addresses; a broadcast would gather all that in the driver.
    """
    return left.join(right.hint("merge"), on, how)


def _differences(asked: DataFrame, orders: list[DataFrame], folds: bool, scratch: Scratch) -> DataFrame:
    """Rows (run, differences): log-likelihood of accepted less rejected of its last character.

    asked has distinct runs. With folds there is a value without the counts of each
    fold, and one of all counts behind them; else that one only.
    """
    slots = FOLDS + 1 if folds else 1

    def counts(name: str, alias: str) -> Column:
        rest = [F.col(name) - F.get(f"{name}_own", F.lit(f)) for f in range(slots - 1)]
        return F.array(*rest, F.col(name)).alias(alias)

    out, lower = None, None
    for k, order in enumerate(orders):
        # Each distinct run of an order meets the model, and what is known of its end, once.
        rows = _shortened(asked, k)
        rows = rows if k == ORDER else rows.distinct()
        seen = order.select(F.col("run").alias("of"), *(counts(v, f"{v}_n") for v in VERDICTS))
        every = [c for c in order.columns if "_all" in c]
        context = order.select("context", *every).distinct()
        context = context.select("context", *(counts(f"{v}_all", f"{v}_every") for v in VERDICTS))
        rows = _joined(rows, seen, F.col("run") == F.col("of"), "left")
        before = F.substr("run", F.lit(1), F.lit(k))
        rows = _joined(rows, context, before == F.col("context"), "left")
        if k:
            rows = _joined(rows, lower, F.substr("run", F.lit(2)) == F.col("end"))

        def chance(model: str, slot: int, k: int = k) -> Column:
            at = F.lit(slot)
            n, of = (F.coalesce(F.get(f"{model}_{c}", at), F.lit(0)) for c in ("n", "every"))
            shorter = F.get(f"{model}_end", at) if k else F.lit(1.0 / CHARACTERS)
            return (n + F.lit(BACKOFF) * shorter) / (of + BACKOFF)

        chances = {v: F.array(*(chance(v, s) for s in range(slots))) for v in VERDICTS}
        rows = rows.select("run", *(c.alias(v) for v, c in chances.items()))
        if k < ORDER:
            rows = scratch.keep(rows, f"chances-{k}")
            lower = rows.select(F.col("run").alias("end"), *(F.col(v).alias(f"{v}_end") for v in VERDICTS))
            # Shorter ones are whole runs at the start only.
            rows = rows.filter(F.col("run").startswith(START))
        logs = [F.log(F.get("allow", F.lit(s))) - F.log(F.get("block", F.lit(s))) for s in range(slots)]
        rows = rows.select("run", F.array(*logs).alias("differences"))
        out = rows if out is None else out.unionByName(rows)
    return out


def scored(urls: DataFrame, orders: list[DataFrame]) -> DataFrame:
    """Rows (key, difference): log-likelihood of accepted less rejected, per character.

    urls has ``key`` and ``url``; each distinct key comes back once. If urls has
    ``fold``, the counts of that fold are left out (none, if it is null). A row for each
    character meets one table only, that of its run's difference: short keys are cheap.
    """
    folds = "fold" in urls.columns
    scratch = Scratch(urls.sparkSession, "scores")
    rows = _runs(urls, F.col("url"), ["key", "fold"] if folds else ["key"])
    asked = scratch.keep(rows.select("run").distinct(), "asked")
    table = _differences(asked, orders, folds, scratch).withColumnRenamed("run", "of")
    slot = F.coalesce("fold", F.lit(FOLDS)) if folds else F.lit(0)
    judged = _joined(rows, table, F.col("run") == F.col("of"))
    difference = F.avg(F.get("differences", slot))
    return judged.groupBy("key").agg(difference.alias("difference"))


def calibrated(scores: DataFrame) -> float:
    """The threshold with the least sum of both error rates on labelled scores.

    Works on the counts of BINS bins; 0 unless both verdicts are there.
    """
    at = F.floor((F.col("difference") + SPREAD) / (2 * SPREAD) * BINS)
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), at)).cast("int")
    rows = scores.groupBy(at.alias("bin"), "verdict").count().collect()
    counts = {v: [0] * BINS for v in ("allow", "block")}
    for row in rows:
        counts[row["verdict"]][row["bin"]] = row["count"]
    allow, block = sum(counts["allow"]), sum(counts["block"])
    if not allow or not block:
        return 0.0
    missed, passed, errors = 0, block, []
    for k in range(BINS + 1):
        errors.append(missed / allow + passed / block)
        if k < BINS:
            missed += counts["allow"][k]
            passed -= counts["block"][k]
    best = [k for k, e in enumerate(errors) if e <= min(errors) + 1e-12]
    middle = (best[0] + best[-1]) / 2
    return middle / BINS * 2 * SPREAD - SPREAD


def judge(
    pages: DataFrame,
    scratch: Scratch,
    id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """Rows (id, host, path, rule, difference, verdict), one for each row of pages.

    An address that no rule decides is allowed if its difference is the
    threshold or more. A null address, or one without ``://``, has an empty
    host and path; as text it is judged like any other (null as empty).
    Models and threshold count every labelled address, each distinct one once.
    Without labelled addresses of both kinds the threshold is 0; of thresholds that
    are equally good the middle one is taken. Each distinct address is scored once,
    whole, whatever its length; rows that repeat come back as often as they came, an
    empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(F.col(id).alias("page"), text.alias("url"))
    decided = ruled(*address(F.col("url")), rules)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).cast("int")
    distinct = rows.select("url").distinct().withColumn("verdict", decided["verdict"])
    distinct = distinct.withColumn("fold", F.when(F.col("verdict").isNotNull(), fold))
    # Written, so that the short key which stands for an address stays the same.
    distinct = scratch.keep(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct")
    labelled = distinct.filter(F.col("verdict").isNotNull())
    orders = train(labelled.select("url", "verdict", "fold"), scratch)
    scores = scratch.keep(scored(distinct.select("key", "url", "fold"), orders), "scores")
    by_url = distinct.select(F.col("key").alias("of"), F.col("url").alias("key"), "verdict")
    scores = _joined(scores.withColumnRenamed("key", "by"), by_url, F.col("by") == F.col("of"))
    scores = scores.select("key", "verdict", "difference")
    threshold = calibrated(scores.filter(F.col("verdict").isNotNull()))
    unruled = scores.filter(F.col("verdict").isNull()).select("key", "difference")
    joined = rows.join(unruled, F.col("url") == F.col("key"), "left")
    host, path = address(F.col("url"))
    joined = joined.withColumns({"host": host, "path": path})
    joined = joined.withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    model = F.when(F.col("difference") >= threshold, "allow").otherwise("block")
    return joined.select(
        F.col("page").alias(id),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        "difference",
        F.coalesce("found.verdict", model).alias("verdict"),
    )
