"""Personal data by weak supervision.

Patterns give candidate spans of several kinds. On each, labelers vote for, against or not
at all: by the form of the value, by lists of known parts (gazetteers) and by the words
around it. Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is and how likely each pattern is personal data; with these probabilities as
soft labels a logistic classifier on features of the span is trained, and its verdict
decides on the kinds that the fixed rules don't cover. Spans of the fixed rules (email, ip,
card, phone) stay in any case.

Everything runs as DataFrame expressions; the driver sees only the table of vote patterns,
whose size is bounded by the number of labelers.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm.common import materialize, read_table

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("secret", "iban", "local_phone")
# leftmost matches; possessive where nothing would change by giving back, and starts
# inside a run skipped, so that long runs take linear time and no deep recursion
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    # runs of under 13 digits would be dropped anyway
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# a text without this has no match
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]{11}", "phone": r"\+[0-9]", "secret": "[A-Za-z0-9_-]{20}",
         "iban": "[A-Z]{2}[0-9]{2}", "local_phone": "[0-9]{3}[ .-][0-9]{4}"}
# gazetteers: known parts of values
DOMAINS = "com|org|net|edu|gov|io|info|eu|de|fr|es|it|uk|us|ch|at|nl|be|pl|pt|br|mx|jp|cn|in|ru|ca|au"
COUNTRY_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
KEY_PREFIXES = "sk-|pk-|ghp_|gho_|xox[bap]-|AKIA|ASIA|AIza|eyJ"
IBAN_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE"
# words that announce a kind
CONTEXT = {"email": "mail|contact|write|schreib|correo|courriel", "ip": r"\bip\b|host|server|addr|client|login",
           "card": "card|visa|master|amex|credit|karte|carte|tarjeta", "phone": "tel|phone|call|fax|mobile|handy|ruf",
           "secret": "token|secret|key|passw|pwd|auth|bearer|credential", "iban": "iban|konto|account|compte|cuenta|bank",
           "local_phone": "tel|phone|call|fax|mobile|handy|ruf"}
LABELERS = ("form", "gazetteer", "context", "assigned", "plain")
EM_STEPS = 60
KEEP_AT = 0.5


def _per_kind(of: dict[str, Column], otherwise) -> Column:
    got = None
    for k, c in of.items():
        got = F.when(F.col("kind") == k, c) if got is None else got.when(F.col("kind") == k, c)
    return got.otherwise(otherwise)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def candidates(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end, value, before, after) of every match of every pattern, from
    rows (key, text); code points, end exclusive. Rows with equal keys count once."""
    def found(kind):
        gaps, hits = F.split("text", PATTERNS[kind], -1), F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.col("text").rlike(NEEDS[kind]), F.struct(F.lit(kind).alias("kind"), gaps.alias("gaps"), hits.alias("hits")))

    d = docs.select("key", F.explode(F.array(*[found(k) for k in KINDS])).alias("m")).filter("size(m.hits) > 0")
    d = d.select("key", "m.kind", F.col("m.gaps").alias("gaps"), F.posexplode("m.hits").alias("i", "value"))
    gap = F.get("gaps", F.col("i"))
    d = d.select("key", "kind", "i", "value", F.length(gap).alias("gap"), F.right(gap, F.lit(32)).alias("before"),
                 F.left(F.get("gaps", F.col("i") + 1), F.lit(8)).alias("after"))
    d = materialize(d.dropDuplicates(["key", "kind", "i"]), "matches")
    upto = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    d = d.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return d.filter(valid()).select("key", "kind", "start", "end", "value", "before", "after")


def luhn(number: Column) -> Column:
    """Whether the digits of a string of 13 to 19 digits pass the Luhn check."""
    total = F.lit(0)
    for i in range(19):  # from the last digit on
        x = F.substring(F.reverse(number), i + 1, 1).try_cast("int")
        x = x if i % 2 == 0 else F.when(x > 4, x * 2 - 9).otherwise(x * 2)
        total = total + F.coalesce(x, F.lit(0))
    return total % 10 == 0


def valid() -> Column:
    """The fixed rules on what matched; the other kinds pass."""
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    n = F.length(_digits(F.col("value")))
    return _per_kind({"ip": F.col("value").rlike(rf"^{part}(?:\.{part}){{3}}$"), "phone": n.between(9, 15),
                      "card": n.between(13, 19) & luhn(_digits(F.col("value")))}, F.lit(True))


def votes(spans: DataFrame) -> DataFrame:
    """Append a column per labeler: 1 for, -1 against, 0 no vote."""
    v, b = F.col("value"), F.lower("before")
    digits = _digits(v)
    varied = F.size(F.array_distinct(F.split(digits, "")))

    def vote(yes, no=None):
        out = F.when(yes, 1)
        return (out.when(no, -1) if no is not None else out).otherwise(0)

    form = _per_kind({
        "email": vote(v.rlike(r"^[A-Za-z0-9][^@]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), v.rlike(r"@[0-9.]+$")),
        "ip": vote(~v.rlike(r"(?:^|\.)0[0-9]"), v.rlike(r"^0\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$")),
        "card": vote(varied >= 4, varied <= 2), "phone": vote(v.rlike(r"[ ().-]") & (varied >= 4), varied <= 2),
        "secret": vote(v.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | (v.rlike("[A-Z]") & v.rlike("[a-z]") & (F.length(digits) >= 4)),
                       v.rlike("^[A-Za-z_-]+[0-9]{1,4}$")),
        "iban": vote(F.length(F.regexp_replace(v, " ", "")).between(15, 34) & (F.length(digits) >= 10), F.length(digits) < 8),
        "local_phone": vote(v.rlike(r"^\([0-9]{3}\)") & (varied >= 4), varied <= 2)}, F.lit(0))
    gazetteer = _per_kind({
        "email": vote(v.rlike(rf"(?i)\.(?:{DOMAINS})$"), v.rlike(r"(?i)\.(?:png|jpg|gif|js|css)$")),
        "ip": vote(F.lit(False), v.rlike(r"^(?:127|0|255)\.")),
        "card": vote(digits.rlike(f"^(?:{ISSUERS})"), digits.rlike("^[01789]")), "phone": vote(v.rlike(rf"^\+(?:{COUNTRY_CODES})")),
        "secret": vote(v.rlike(f"^(?:{KEY_PREFIXES})")), "iban": vote(v.rlike(f"^(?:{IBAN_COUNTRIES})"), ~v.rlike(f"^(?:{IBAN_COUNTRIES})")),
        "local_phone": vote(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[01]"))}, F.lit(0))
    context = vote(_per_kind({k: b.rlike(c) for k, c in CONTEXT.items()}, F.lit(False)), b.rlike(r"(?:version|ver\.|build|isbn|figure|section|§)\W*$"))
    assigned = vote(b.rlike(r"""[=:]\s*["']?$"""), b.rlike(r"[/\\#$]$"))
    plain = vote(F.lit(False), F.coalesce(F.col("after"), F.lit("")).rlike("^[A-Za-z0-9_]") | b.rlike(r"[a-z0-9_]$"))
    return spans.withColumns(dict(zip(LABELERS, (form, gazetteer, context, assigned, plain))))


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], steps: int = EM_STEPS) -> dict[tuple[str, tuple[int, ...]], float]:
    """EM for two classes with conditionally independent labelers: probability per (kind,
    votes) from counts of them. Each labeler's chances of the three votes per class and each
    kind's share of true spans are estimated; add-one priors keep labelers better than chance."""
    p = {(k, v): 1 / (1 + math.exp(-sum(v) - 0.5)) for k, v, _ in patterns}
    if not patterns:
        return p
    width = len(patterns[0][1])
    for _ in range(steps):
        share: dict[str, list[float]] = {}
        table = [[{-1: 0.5 + (y == 0), 0: 1.0, 1: 0.5 + (y == 1)} for _ in range(width)] for y in (0, 1)]
        for k, v, n in patterns:
            q = p[k, v]
            s = share.setdefault(k, [1.0, 1.0])
            s[1] += n * q
            s[0] += n * (1 - q)
            for j, x in enumerate(v):
                table[1][j][x] += n * q
                table[0][j][x] += n * (1 - q)
        total = [[sum(t.values()) for t in table[y]] for y in (0, 1)]
        for k, v, _ in patterns:
            z = math.log(share[k][1] / share[k][0]) + sum(
                math.log(table[1][j][x] / total[1][j]) - math.log(table[0][j][x] / total[0][j]) for j, x in enumerate(v))
            p[k, v] = min(1 - 1e-6, max(1e-6, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
    return p


def features() -> dict[str, Column]:
    """0/1 features of a span: kind, length, shares of digits and capitals, variety, neighbours."""
    v, b = F.col("value"), F.lower("before")
    n = F.length("value")
    share = F.length(_digits(v)) / n
    out = {f"kind_{k}": F.col("kind") == k for k in KINDS[:-1]}
    out |= {"longer": n >= 16, "long": n >= 32, "some_digits": share >= 0.2, "most_digits": share >= 0.6,
            "capitals": v.rlike("[A-Z]"), "small": v.rlike("[a-z]"), "signs": v.rlike("[^A-Za-z0-9]"),
            "varied": F.size(F.array_distinct(F.split(v, ""))) >= 8, "quoted": b.rlike("""["'=:]\\s*$"""), "spaced": b.rlike(r"(?:^|\s)$"),
            "announced": _per_kind({k: b.rlike(c) for k, c in CONTEXT.items()}, F.lit(False))}
    return {k: F.coalesce(c, F.lit(False)).cast("double") for k, c in out.items()}


def classify(spans: DataFrame) -> Column:
    """Probability of each span by the classifier trained on the labelers' estimates."""
    voted = materialize(votes(spans).withColumns(features()), "voted")
    names = list(features())
    # at most kinds * 3 ** labelers rows
    counted = voted.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    p = estimate([(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in counted])
    if not p:
        return F.lit(0.0)
    spark = spans.sparkSession
    soft = spark.createDataFrame([(k, *v, q) for (k, v), q in p.items()], "kind string, " + ", ".join(f"{x} int" for x in LABELERS) + ", p double")
    rows = voted.groupBy("kind", *LABELERS, *names).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(soft), ["kind", *LABELERS])
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("w")),
                             F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("w"))))
    rows = rows.select(*names, both.alias("x")).groupBy(*names, "x.label").agg(F.sum("x.w").alias("w"))
    rows = materialize(VectorAssembler(inputCols=names, outputCol="x").transform(rows.select(*names, "label", "w")).select("x", "label", "w"), "soft")
    model = LogisticRegression(featuresCol="x", labelCol="label", weightCol="w", regParam=1e-3, maxIter=30, standardization=False).fit(rows.coalesce(1))
    z = F.lit(float(model.intercept))
    for c, w in zip(features().values(), model.coefficients):
        z = z + c * F.lit(float(w))
    return 1 / (1 + F.exp(-z))


def spans(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """(key, kind, start, end, base) of the personal data in rows (key, text): all spans of
    the fixed rules, and those of the other kinds that the classifier keeps and that overlap
    none of them. Null text: none."""
    c = materialize(candidates(docs), "candidates")
    c = c.withColumn("base", F.col("kind").isin(*BASE)).withColumn("p", classify(c))
    by_start = Window.partitionBy("key").orderBy("start", "end", "kind")
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    c = c.withColumns({"reach": F.max(base_end).over(by_start.rowsBetween(Window.unboundedPreceding, -1)),
                       "next": F.min(base_start).over(by_start.rowsBetween(1, Window.unboundedFollowing))})
    apart = F.coalesce(F.col("reach") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True))
    return c.filter(F.col("base") | (apart & (F.col("p") >= keep_at))).select("key", "kind", "start", "end", "base")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: doc_id, found = array of (order, start, end, kind, base), by kind
    as in KINDS, then start.

    Null or empty text: no span. Repeated rows and ids: a row each; rows that agree in id and
    text are counted once in training. Empty table: empty result. Other columns are not read.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit("\n"), t)))
    d = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), t.alias("text"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    found = spans(d.select("key", "text"), keep_at).groupBy(F.col("key").alias("f_key")).agg(
        F.sort_array(F.collect_list(F.struct(order.alias("order"), "start", "end", "kind", "base"))).alias("found"))
    found = materialize(found, "found")
    return d.join(found, d.key == found.f_key, "left").select(
        "doc_id", F.coalesce("found", F.array().cast(dict(found.dtypes)["found"])).alias("found"))


def digest(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find(read_table(spark, sf_dir, "documents"))
    of = lambda k: F.filter("found", lambda x: x["kind"] == k)
    count = {f"n_{k}": F.size(of(k)).cast("long") for k in BASE}
    return d.withColumns(count | {"base_sha256": F.sha2(digest(F.filter("found", lambda x: x["base"])), 256), "spans": digest(F.col("found"))}).drop("found")
