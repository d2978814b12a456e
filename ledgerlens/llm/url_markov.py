"""URL filter: host/path rules, then a character language-model ratio.

URLs that a rule allows or blocks are the accepted and rejected examples. Two
variable-order Markov models of characters (orders 0 to ORDER, Witten-Bell
interpolation, an unseen context leaves the shorter one's estimate alone) learn
from four fifths of them; the threshold on the length-normalised difference of
the log-likelihoods is calibrated on the other fifth. DataFrame functions only.

All URLs are cut into windows of ORDER + 1 characters. Windows are counted
before anything is shuffled; a model is a table by window, joined to the
windows of each URL. Windows that stand in every URL ("http:") are hot join
keys: both sides carry a salt of SALTS values.

Null url or none with "://": host and path are empty, no rule fits, the model
judges the text there is (at least its end). Without examples of both kinds
every difference is 0 and the verdict is allow. Rows that repeat, also in
page_id, are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, written

ORDER = 4
SALTS = 16
#: Size of the alphabet that the models back off to in the end.
ALPHABET = 256
#: Calibration: bins of this width, up to LIMIT nats a character.
BIN, LIMIT = 0.01, 20.0
#: verdict, host, path
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
OPEN, CLOSE = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    return pages.withColumns({
        "host": F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit("")),
        "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))})


def rule_of(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def windows(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per character of ``text`` and one for its end: ``gram``, the
    character after its ``order`` predecessors."""
    chars = F.split(F.concat(F.lit(OPEN * order), F.col("text"), F.lit(CLOSE)), "")
    cut = F.transform(F.sequence(F.lit(0), F.size("chars") - (order + 1)),
                      lambda i: F.concat(*(F.get(F.col("chars"), i + k) for k in range(order + 1))))
    return (urls.withColumn("chars", F.filter(chars, lambda c: c != ""))
                .withColumn("gram", F.explode(cut)).drop("chars", "text"))


def ratios(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, diff: log-probability of the gram's last character after the
    others, under the accepted minus under the rejected model. ``grams``:
    gram, a, r (counts in either kind of example)."""
    below = None
    for k in range(order + 1):
        own = grams.groupBy(F.expr(f"right(gram, {k + 1})").alias("s")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        own = own.withColumn("ctx", F.expr(f"left(s, {k})"))
        ctx = own.groupBy("ctx").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"),
                                     F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
        level = own.join(ctx, "ctx")
        if below is None:
            level = level.withColumns({"qa": F.lit(1.0 / ALPHABET), "qr": F.lit(1.0 / ALPHABET)})
        else:
            level = level.withColumn("t", F.expr(f"right(s, {k})")).join(below, "t")
        mixed = lambda n, c, t, q: F.when(F.col(n) > 0, (F.col(c) + F.col(t) * F.col(q)) / (F.col(n) + F.col(t))).otherwise(F.col(q))
        below = level.select(F.col("s").alias("t"), mixed("na", "a", "ta", "qa").alias("qa"), mixed("nr", "r", "tr", "qr").alias("qr"))
    return below.select(F.col("t").alias("gram"), (F.log("qa") - F.log("qr")).alias("diff"))


def calibrated(scored: DataFrame) -> float:
    """Threshold of best balanced accuracy over ``score`` and ``accepted``
    (boolean): the middle of the best stretch of bins. Two thousand rows of counts at
    most come to the driver."""
    bins = (scored.groupBy(F.floor(F.greatest(F.least(F.col("score"), F.lit(LIMIT)), F.lit(-LIMIT)) / BIN).cast("long").alias("bin"))
                  .agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).orderBy("bin").collect())
    all_a, all_r = sum(b.a for b in bins), sum(b.r for b in bins)
    if not all_a or not all_r:
        return 0.0
    best, first, last, a, r = -1.0, 0, 0, 0, 0
    for i, b in enumerate(bins):  # threshold at the bin's lower edge
        got = (all_a - a) / all_a + r / all_r
        if got > best + 1e-12:
            best, first = got, b.bin
            last = bins[i - 1].bin + 1 if i else b.bin
        a, r = a + b.a, r + b.r
    return (first + last) / 2 * BIN


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (null where a rule decides)."""
    rule, verdict = rule_of(rules)
    # numbered rows, written: numbers stay as they are when a stage runs again
    base = with_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")))
    base = base.withColumn("rule", rule).withColumn("by_rule", verdict)
    base = base.withColumn("text", F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER)).drop("url")
    base = written(base.withColumn("uid", F.monotonically_increasing_id()), "urls")
    fold = F.conv(F.left(F.md5(F.col("text").cast("binary")), F.lit(8)), 16, 10).cast("long") % 5
    learn = F.col("by_rule").isNotNull() & (fold != 0)
    grams = windows(base.select("text", (learn & (F.col("by_rule") == "allow")).alias("is_a"), (learn & (F.col("by_rule") == "block")).alias("is_r")))
    grams = grams.groupBy("gram").agg(F.count_if("is_a").alias("a"), F.count_if("is_r").alias("r"))
    model = written(ratios(written(grams, "url_grams")), "url_model")

    # rows that need a score: those without a rule, and the calibration fold
    todo = base.filter(F.col("by_rule").isNull() | (fold == 0))
    cut = windows(todo.select("uid", "text")).withColumn("salt", (F.pmod(F.xxhash64("uid"), F.lit(SALTS))).cast("int"))
    salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    score = (cut.join(salted, ["gram", "salt"]).groupBy("uid")
                .agg(F.round(F.sum("diff") / F.count("*"), 9).alias("score")))
    score = written(score, "url_scores")
    examples = base.filter(F.col("by_rule").isNotNull() & (fold == 0)).select("uid", (F.col("by_rule") == "allow").alias("accepted"))
    limit = calibrated(score.join(examples, "uid"))
    out = base.join(score, "uid", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("by_rule", F.when(F.col("score") >= limit, "allow").otherwise("block")).alias("verdict"),
                      F.when(F.col("by_rule").isNull(), F.col("score")).alias("score"))


def op8_url_markov_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``."""
    return judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules)
    levels = []
    for k in range(ORDER + 1):
        q = f"1.0::DOUBLE / {ALPHABET}" if k == 0 else "b.q{}"
        join = "" if k == 0 else f"JOIN m{k - 1} b ON b.s = right(o.s, {k})"
        levels.append(f"""
o{k} AS (SELECT right(gram, {k + 1}) AS s, sum(a) AS a, sum(r) AS r FROM grams GROUP BY 1),
c{k} AS (SELECT left(s, {k}) AS ctx, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr FROM o{k} GROUP BY 1),
m{k} AS (SELECT o.s,
    CASE WHEN na > 0 THEN (a + ta * {q.format('a')}) / (na + ta) ELSE {q.format('a')} END::DOUBLE AS qa,
    CASE WHEN nr > 0 THEN (r + tr * {q.format('r')}) / (nr + tr) ELSE {q.format('r')} END::DOUBLE AS qr
  FROM o{k} o JOIN c{k} c ON c.ctx = left(o.s, {k}) {join}),""")
    return f"""
WITH raw AS (
  SELECT row_number() OVER () AS uid, page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS text,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT uid, page_id, text, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM raw),
base AS (
  SELECT p.*, ('0x' || left(md5(text), 8))::BIGINT % 5 AS fold, CASE {rule} END AS rule, CASE {verdict} END AS by_rule
  FROM parts p),
cut AS (
  SELECT uid, by_rule, fold, unnest(list_transform(range(1, length(text) + 2), lambda i: substr(repeat(chr(2), {ORDER}) || text || chr(3), i, {ORDER + 1}))) AS gram
  FROM base),
grams AS (
  SELECT gram, count(*) FILTER (by_rule = 'allow' AND fold <> 0) AS a, count(*) FILTER (by_rule = 'block' AND fold <> 0) AS r
  FROM cut GROUP BY gram),{"".join(levels)}
score AS (
  SELECT uid, round(sum(ln(qa) - ln(qr)) / count(*), 9) AS score FROM cut JOIN m{ORDER} m ON m.s = cut.gram GROUP BY uid),
bins AS (
  SELECT floor(greatest(least(score, {LIMIT}), -{LIMIT}) / {BIN})::BIGINT AS bin, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS r
  FROM base JOIN score USING (uid) WHERE by_rule IS NOT NULL AND fold = 0 GROUP BY 1),
edge AS (
  SELECT bin, coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) AS low,
         1 - coalesce(sum(a) OVER w, 0) / sum(a) OVER () + coalesce(sum(r) OVER w, 0) / sum(r) OVER () AS got
  FROM bins WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT (bin + low) / 2 * {BIN} FROM edge WHERE got > (SELECT max(got) FROM edge) - 1e-12 ORDER BY bin LIMIT 1), 0) AS t)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN score >= (SELECT t FROM best) THEN 'allow' ELSE 'block' END) AS verdict
FROM base LEFT JOIN score USING (uid)
"""


OP8_SQL = _sql()
