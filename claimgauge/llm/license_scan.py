"""Licence families of documents, paragraph by paragraph.

A paragraph is a run of lines that each have a word (of ASCII letters or
digits); notices as published are wrapped over several. Each of its lines is
judged alone besides, so that a notice of one line within prose is confirmed
where it stands. A paragraph of several lines is left out where one of its lines says
as much: has the same family, and is confirmed if the paragraph is.

A paragraph's words, pairs and triples of words are the features of a sparse
multinomial logistic regression that knows the licence families and an unknown
class. It is trained on notices, on notices with words left out and words
around them, on sentences that only look like notices, and on paragraphs of the
corpus without any licence word. Whether a paragraph is known at all is a
probability, calibrated on whole notices and sentences that a first model has
not seen in any variant. A prediction
is confirmed by the family's templates: the share of a template's word triples
that the paragraph holds has to reach ``least_coverage``.

All work on the corpus is column functions and joins with tables that are
bounded by the vocabulary. A paragraph that holds no telling word of the vocabulary has
none of its features, and is unknown without being looked at further. What
is left of a paragraph is counted per document and place, so that a hot source or a notice in
very many documents is no group of its own.

Training reads about ``sample_docs`` whole documents, chosen by a hash of the
text, and of their distinct paragraphs about ``sample_paragraphs``, chosen by a hash as well.

Defined results: null and empty texts have no paragraph and no licence. Rows
with equal doc_id and text get the same result each.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimgauge.llm.license_texts import LOOKALIKES, NOTICES, PLAIN_WORDS
from claimgauge.llm.text_columns import bounded_sample
from claimgauge.sources.scratch import stage

UNKNOWN = "unknown"


@dataclass(frozen=True)
class ScanPlan:
    line_break: str = "\n"
    vocabulary: int = 4000
    sample_docs: int = 300
    sample_paragraphs: int = 6000
    variants: int = 12
    least_known: float = 0.5
    least_coverage: float = 0.5
    seed: int = 41


@dataclass
class ScanModel:
    plan: ScanPlan
    families: list[str]
    #: feature, then a weight per family and for unknown
    weights: list[tuple]
    intercepts: list[float]
    #: a and b of the probability of being known, sigmoid(a + b * margin)
    known: tuple[float, float]
    telling: list[str] = field(default_factory=list)


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def grams(words: str, most: int = 3, least: int = 1) -> Column:
    """Runs of words of a column, joined by blanks."""
    size = F.size(words)

    def runs(n: int) -> Column:
        starts = F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(n))))

    return F.array_distinct(F.concat(*(runs(n) for n in range(least, most + 1))))


def _variants(plan: ScanPlan) -> list[tuple[str, str, int, int]]:
    """Made-up paragraphs: text, family or unknown, number of the variant, and of the notice or sentence behind it."""
    rng, out = random.Random(plan.seed), []
    filler = "the of and to in that it was for on are as with his they at one have this from or had by hot some what there".split()

    def around(words: list[str]) -> str:
        before = [rng.choice(filler) for _ in range(rng.choice([0, 0, 2, 8]))]
        after = [rng.choice(filler) for _ in range(rng.choice([0, 0, 3, 12]))]
        return " ".join(before + words + after)

    known = [(f, t) for f, texts in NOTICES.items() for t in texts]
    for notice, (family, text) in enumerate(known + [(UNKNOWN, t) for t in LOOKALIKES]):
        out.append((text, family, 0, notice))
        for n in range(1, plan.variants):
            words = text.split()
            gone = rng.choice([0, 0.05, 0.15])
            left = [w for w in words if rng.random() >= gone or w.lower().strip(".,") in (family.lower(), "license")]
            out.append((around(left), family, n, notice))
    for n in range(plan.variants * 10):  # words of notices in no order
        words = [w for _ in range(2) for w in rng.choice(known)[1].split()]
        out.append((around(rng.sample(words, min(len(words), rng.randint(1, 6)))), UNKNOWN, n % plan.variants, n))
    return out


def train(docs: DataFrame, plan: ScanPlan = ScanPlan(), text: str = "text") -> ScanModel:
    spark = docs.sparkSession
    body = docs.select(F.col(f"`{text}`").alias("body")).where("body is not null")
    share = min(1.0, plan.sample_docs / max(1, body.count()))
    chosen = body.where(F.pmod(F.xxhash64("body"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    parts = chosen.select(F.explode(F.split("body", plan.line_break)).alias("part")).distinct()
    licensed = F.regexp(F.lower("part"), F.lit("licen|copyright|spdx|public domain"))
    parts = stage(parts.where(~licensed).where(F.regexp("part", F.lit(r"\S"))), "licence-plain")
    plain = sorted(r.part for r in bounded_sample(parts, plan.sample_paragraphs, "part"))
    rows = _variants(plan) + [(p, UNKNOWN, i % plan.variants, i) for i, p in enumerate(plain)]
    families = [*NOTICES, UNKNOWN]
    made = spark.createDataFrame([(t, float(families.index(f)), n, k) for t, f, n, k in rows], "body string, label double, variant int, notice int")
    words = stage(made.select(word_list(F.col("body")).alias("words"), "label", "variant", "notice"), "licence-training")
    telling = sorted({w for r in words.where("variant = 0 and label < " + str(len(NOTICES))).select("words").collect() for w in r.words} - set(PLAIN_WORDS))
    featured = words.select(_telling_grams("words", telling).alias("grams"), "label", "notice")
    counter = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=plan.vocabulary, minDF=2, binary=True).fit(featured)
    ready = stage(counter.transform(featured).select("features", "label", "notice"), "licence-features")
    # a quarter of the notices and sentences, with all their variants
    held = F.pmod(F.xxhash64("notice"), F.lit(4)) == 3
    fitted = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.3, maxIter=60, standardization=False)
    model = fitted.fit(ready)
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray().tolist()
    weights = [(gram, *map(float, matrix[:, i])) for i, gram in enumerate(counter.vocabulary) if abs(matrix[:, i]).max() > 1e-6]
    # calibration: how far the best family is above unknown, where a model has not seen the notice
    logits = fitted.fit(ready.where(~held)).transform(ready.where(held)).select("rawPrediction", "label")
    from pyspark.ml.functions import vector_to_array

    z = vector_to_array("rawPrediction")
    best = F.array_max(F.slice(z, 1, len(NOTICES)))
    margins = logits.select((best - F.get(z, len(NOTICES))).alias("margin"), (F.col("label") < len(NOTICES)).cast("double").alias("label"))
    curve = LogisticRegression(regParam=1e-3).fit(margins.select(array_to_vector(F.array("margin")).alias("features"), "label"))
    return ScanModel(plan, families, weights, intercepts, (float(curve.intercept), float(curve.coefficients[0])), telling)


def _telling_grams(words: str, telling: list[str]) -> Column:
    """Runs of one to three words that hold a telling word."""
    known = F.array(*map(F.lit, telling))
    return F.filter(grams(words), lambda g: F.arrays_overlap(F.split(g, " "), known))


def templates(spark: SparkSession) -> DataFrame:
    """family, template, gram, n_grams: the word triples of each notice; of shorter notices the whole."""
    rows = [(f, f"{f}/{i + 1}", t) for f, texts in NOTICES.items() for i, t in enumerate(texts)]
    made = spark.createDataFrame(rows, "family string, template string, body string").withColumn("words", word_list(F.col("body")))
    runs = F.when(F.size("words") < 3, F.array(F.concat_ws(" ", "words"))).otherwise(grams("words", 3, 3))
    made = made.select("family", "template", runs.alias("runs"))
    return made.select("family", "template", F.size("runs").alias("n_grams"), F.explode_outer("runs").alias("gram"))


def _paragraphs(body: Column, line_break: str) -> Column:
    """Runs of lines that each have a word, joined by line feeds; each line begins with its number in the text and a colon."""
    word = F.lit("[A-Za-z0-9]")
    lines = F.transform(F.split(body, line_break), lambda s, i: F.when(F.regexp(s, word), F.concat(i, F.lit(":"), F.translate(s, "\n", " "))).otherwise(""))
    return F.split(F.btrim(F.array_join(lines, "\n"), F.lit("\n")), "\n\n+")


def _words_by_place(wanted: DataFrame) -> dict[int, list[list[str]]]:
    """Of the runs of one, two and three words, the words that stand at each place; as many as ``wanted`` has at most."""
    words = F.split("gram", " ")
    placed = wanted.where("gram is not null").select(F.size(words).alias("size"), F.posexplode(words).alias("place", "word")).distinct()
    found: dict[int, list[list[str]]] = {k: [[] for _ in range(k)] for k in (1, 2, 3)}
    for row in placed.orderBy("size", "place", "word").collect():
        found[row["size"]][row["place"]].append(row["word"])
    return found


def _placed_grams(places: dict[int, list[list[str]]]) -> Column:
    """Runs of ``words`` with known words at all places, as (gram, line, last): the lines of its first and its last word."""
    size = F.size("words")

    def runs(k: int) -> Column:
        # of places, where a word of ``words`` opens a run
        starts = F.filter("opened", lambda i: reduce(and_, (F.get("words", i + j).isin(known) for j, known in enumerate(places[k])), i + k <= size))
        return F.transform(
            starts,
            lambda i: F.struct(
                F.concat_ws(" ", *(F.get("words", i + j) for j in range(k))).alias("gram"),
                F.get("line_of", i).alias("line"), F.get("line_of", i + (k - 1)).alias("last"),
            ),
        )

    return F.concat(*(runs(k) for k in (1, 2, 3)))


def _entries() -> Column:
    """A run's entries, as (line, lines): of its line, and of a paragraph of several."""
    entry = lambda line, lines: F.struct(line.alias("line"), lines.alias("lines"))
    single = F.when(F.col("g.line") == F.col("g.last"), F.array(entry(F.col("g.line"), F.lit(1))))
    whole = F.when(F.col("n_lines") > 1, F.array(entry(F.lit(0), F.col("n_lines"))))
    none = F.array().cast("array<struct<line:int,lines:int>>")
    # repeats go after the shuffle: array_distinct of structs compares all with all
    return F.concat(F.coalesce(single, none), F.coalesce(whole, none))


def scan_paragraphs(docs: DataFrame, model: ScanModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Paragraphs and lines that are not unknown: doc_id, version, paragraph (its first line's number), lines, family, score, template, coverage, confirmed."""
    spark, plan = docs.sparkSession, model.plan
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("body")).where("body is not null")
    rows = rows.select("doc_id", F.xxhash64("body").alias("version"), F.explode(_paragraphs(F.col("body"), plan.line_break)).alias("part")).where("part <> ''")
    rows = rows.select("doc_id", "version", F.substring_index("part", ":", 1).cast("int").alias("part_line"), F.split("part", "\n").alias("lines"))
    plain = lambda s: F.regexp_replace(s, F.lit("^[0-9]+:"), F.lit(""))
    # each of these columns is used more than once by the next, and so is made once
    rows = rows.select("doc_id", "version", "part_line", F.transform("lines", lambda s: word_list(plain(s))).alias("by_line"))
    line_of = F.flatten(F.transform("by_line", lambda ws, i: F.array_repeat(i, F.size(ws))))
    rows = rows.select("doc_id", "version", "part_line", F.size("by_line").alias("n_lines"), F.flatten("by_line").alias("words"), line_of.alias("line_of"))
    place = ("doc_id", "version", "part_line", "paragraph", "lines")
    names = [f"w{i}" for i in range(len(model.families))]
    # as many rows as the vocabulary at most, and as the templates have triples
    weights = spark.createDataFrame(model.weights, "gram string, " + ", ".join(f"{n} double" for n in names))
    wanted = weights.select("gram").union(templates(spark).select("gram")).distinct()
    places = _words_by_place(wanted)
    openers = sorted({word for of_size in places.values() for word in of_size[0]})
    # without a telling word there is no feature; null and no place alike have no run
    telling = F.exists("words", lambda w: w.isin(model.telling)) & (F.size("words") > 0)
    opened = F.when(telling, F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(openers)))
    rows = rows.select("*", opened.alias("opened"))
    # only runs that a feature or a template has are shuffled; equal rows of documents would count theirs twice
    found = rows.select("doc_id", "version", "part_line", "n_lines", F.explode(_placed_grams(places)).alias("g"))
    found = found.join(F.broadcast(wanted), F.col("g.gram") == F.col("gram")).select("doc_id", "version", "part_line", "gram", F.explode(_entries()).alias("e"))
    found = found.select("doc_id", "version", "part_line", (F.col("part_line") + F.col("e.line")).alias("paragraph"), "e.lines", "gram")
    found = stage(found.distinct(), "licence-grams")
    logits = found.join(F.broadcast(weights), "gram").groupBy(*place).agg(
        *((F.sum(n) + F.lit(b)).alias(n) for n, b in zip(names, model.intercepts, strict=True))
    )
    best = F.array_max(F.array(*(F.struct(F.col(n).alias("logit"), F.lit(f).alias("family")) for n, f in zip(names[:-1], model.families, strict=False))))
    logits = logits.select(*place, best.alias("best"), F.col(names[-1]).alias("unknown"))
    a, b = model.known
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * (F.col("best.logit") - F.col("unknown")))))
    guessed = logits.select(*place, F.col("best.family").alias("family"), score.alias("score")).where(F.col("score") >= plan.least_known)
    # as many rows as the templates have triples
    held = found.join(F.broadcast(templates(spark)), "gram").groupBy(*place, "family", "template", "n_grams").agg(F.count("*").alias("n"))
    share = F.col("n") / F.col("n_grams")
    closest = held.groupBy(*place, "family").agg(F.max(F.struct(share.alias("coverage"), "template")).alias("closest"))
    # both sides have one row per paragraph with a telling word
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*place, "family")]
    out = guessed.alias("g").join(closest.alias("c"), reduce(and_, same), "left")
    coverage = F.coalesce(F.col("c.closest.coverage"), F.lit(0.0))
    out = out.select(
        *(F.col(f"g.{c}") for c in (*place, "family", "score")), F.col("c.closest.template").alias("template"),
        coverage.alias("coverage"), (coverage >= plan.least_coverage).alias("confirmed"),
    )
    # what the lines of a paragraph say for its family: null for nothing, else whether one is confirmed
    by_line = F.max(F.when(F.col("lines") == 1, F.col("confirmed"))).over(Window.partitionBy("doc_id", "version", "part_line", "family"))
    out = out.withColumn("by_line", by_line)
    return out.where((F.col("lines") == 1) | F.col("by_line").isNull() | (F.col("by_line") < F.col("confirmed"))).drop("part_line", "by_line")


def scan(docs: DataFrame, model: ScanModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, family (of the first confirmed paragraph), n_guessed, n_confirmed and the paragraphs."""
    per = F.struct("paragraph", "lines", "family", "score", "template", "coverage", "confirmed")
    found = scan_paragraphs(docs, model, text, key).groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(per)).alias("paragraphs"))
    found = stage(found, "licence-documents").withColumnRenamed("doc_id", "of")
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("v"))
    out = stage(slim, "licence-all").join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("v") == F.col("version")), "left")
    out = out.select("doc_id", F.coalesce("paragraphs", F.array().cast(found.schema["paragraphs"].dataType)).alias("paragraphs"))
    sure = F.filter("paragraphs", lambda p: p["confirmed"])
    return out.select(
        "doc_id", F.get(sure, F.lit(0))["family"].alias("family"), F.size("paragraphs").cast("long").alias("n_guessed"),
        F.size(sure).cast("long").alias("n_confirmed"), "paragraphs",
    )
