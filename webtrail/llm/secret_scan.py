"""Secret scans: a random forest that removes false positives among candidate strings.

A candidate is a value of ``MIN_VALUE`` characters or more that is assigned to a telling name
(``password: correct-horse``, ``token = 'p@ss!w0rd'``, with up to four white-space characters around the sign), or else a run of
at least ``MIN_LENGTH`` letters, digits, ``_``, ``+``, ``/`` or ``-`` with a digit.  Its features: length, shares of digits, upper-case letters and hexadecimal characters,
character transitions (changes between lower case, upper case, digits and signs), different
characters, Shannon entropy, dictionary coverage (the share of it in letter runs that are words of
at least ``MIN_DOCUMENTS`` documents), its path (depth, and whether it names tests or examples) and
its neighbouring words (telling names and assignments before it, placeholders around it; of what
stands before it, two words and its own, no further back than the finding before, and of what stands
after it one word, both within the nearest ``CONTEXT`` characters).  The
forest is trained on labelled findings, at most ``max_findings`` of them; dictionary counts cover
all documents.

Only DataFrame functions and Spark ML run here.  Documents without a candidate drop out at the
scan; candidates carry no text on.

Null and empty texts give no findings.  A candidate that occurs again is a finding again, by its
place: (word number, place within the word).  Equal rows repeat their findings.  Without labelled
findings of both kinds the score is the share of secrets among them, 0 if there are none.  An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtrail.llm import common

MIN_LENGTH = 12
MIN_VALUE = 4
_SPACE, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
MIN_DOCUMENTS = 3
CONTEXT = 100
CANDIDATE = rf"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{{{MIN_LENGTH},}}"
#: Words before a candidate that name a secret; words around it that stand for an example.
NAMES = r"(?i)(pass(word|wd)?|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth|bearer|aws)"
#: A name that a value is assigned to, its end (``db_password_2``, ``["token"]``), and the sign between.
_NAME = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_.-]?key|access[_.-]?key|private[_.-]?key|credentials?|bearer)"
_END, _SIGN, _QUOTE, _GAP = r"[A-Za-z0-9_.-]{0,20}[\"'\]]{0,2}", r"(?:=>|:=|[=:])", r"[\"'`]?", r"[\x20\x09-\x0D]{0,4}"
_VALUE = rf"[^\x20\x09-\x0D\"'`,;=:<>(){{}}\[\]&|\\]{{{MIN_VALUE},}}"
#: A finding.  The short look behind spares the long one at most places.
FINDING = f"(?<=[=:>]{_GAP}{_QUOTE})(?<={_NAME}{_END}{_GAP}{_SIGN}{_GAP}{_QUOTE}){_VALUE}|{CANDIDATE}"
PLACEHOLDERS = r"(?i)(example|sample|dummy|placeholder|changeme|redacted|test)"
PATHS = r"(?i)(^|[/_.\-])(tests?|examples?|samples?|fixtures?|docs?)([/_.\-]|$)"
FEATURES = ["f_length", "f_digits", "f_upper", "f_hex", "f_changes", "f_different", "f_entropy", "f_dictionary",
            "f_depth", "f_test_path", "f_named", "f_assigned", "f_placeholder"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, path, word_no, place, candidate, before, after): every candidate with the words around it."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(F.col(doc_id).alias("id"), where.alias("path"), F.col(text).alias("t")).filter(F.col("t").rlike(FINDING))
    rows = rows.select("id", "path", F.monotonically_increasing_id().alias("row"), F.split("t", FINDING, -1).alias("parts"),
                       F.regexp_extract_all("t", F.lit(f"({FINDING})"), F.lit(1)).alias("hits"))
    # each finding with the part of the text before it, the finding before that, and the part after it
    rows = rows.select("id", "path", "row", F.posexplode(F.zip_with(
        F.zip_with("hits", F.concat(F.array(F.lit("")), "hits"), lambda hit, last: F.struct(hit.alias("hit"), last.alias("last"))),
        F.zip_with("parts", F.slice("parts", 2, F.size("parts")), lambda part, rest: F.struct(
            F.right(part, F.lit(CONTEXT)).alias("part"), F.left(rest, F.lit(CONTEXT)).alias("rest"),
            F.size(F.split(part, _SPACE)).alias("words"))),
        lambda x, y: F.struct(x["hit"].alias("candidate"), x["last"].alias("last"), y["part"].alias("part"),
                              y["rest"].alias("rest"), y["words"].alias("words")))).alias("no", "x"))
    rows = rows.filter("x.candidate is not null").select("id", "path", "row", "no", "x.*")
    so_far = Window.partitionBy("row").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("word_no", F.sum(F.col("words") - 1).over(so_far).cast("int"))
    rows = rows.withColumn("place", (F.row_number().over(Window.partitionBy("row", "word_no").orderBy("no")) - 1).cast("int"))
    before = F.right(F.concat("last", "part"), F.lit(CONTEXT))
    return rows.select("id", "path", "word_no", "place", "candidate",
                       F.regexp_extract(before, f"(?:{_WORD}*{_SPACE}){{0,2}}{_WORD}*$", 0).alias("before"),
                       F.regexp_extract("rest", f"^{_WORD}*{_SPACE}({_WORD}+)", 1).alias("after"))


def _share(x: Column, pattern: str) -> Column:
    return (F.length(x) - F.length(F.regexp_replace(x, pattern, ""))) / F.length(x)


def _dictionary(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(run): the letter runs of candidates that occur as words in enough documents, counted over all."""
    runs = found.select(F.explode(_runs(F.col("candidate"))).alias("run")).distinct()
    runs = common.small_side(common.stored(runs, "secret-runs"), 1_000_000)
    words = F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}]+"))
    seen = docs.select(F.explode(words).alias("word")).filter(F.length("word") >= 3)
    return seen.join(runs, F.col("word") == F.col("run"), "left_semi").groupBy("word").count().filter(
        F.col("count") >= MIN_DOCUMENTS).select(F.col("word").alias("run"))


def _runs(x: Column) -> Column:
    return F.filter(F.split(F.lower(x), "[^a-z]+"), lambda r: F.length(r) >= 3)


def features(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``found`` (of :func:`candidates`) with the columns FEATURES."""
    c = F.col("candidate")
    n = F.length(c)
    classes = c
    for pattern, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[_+/-]+", "-")):
        classes = F.regexp_replace(classes, pattern, sign)
    letters = F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    share = lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n
    entropy = F.aggregate(letters, F.lit(0.0), lambda acc, x: acc - share(x) * F.log2(share(x)))
    known = _dictionary(found, docs, text)
    covered = found.select("candidate").distinct().select("candidate", F.explode(_runs(c)).alias("run")).join(
        common.small_side(common.stored(known, "secret-words"), 1_000_000), "run").groupBy(F.col("candidate").alias("cand")).agg(
        F.sum(F.length("run")).alias("covered"))
    rows = found.join(covered, c == F.col("cand"), "left").drop("cand")
    path = F.coalesce("path", F.lit(""))
    near = F.concat_ws(" ", "before", "after")
    return rows.withColumns({
        "f_length": n.cast("double"), "f_digits": _share(c, "[0-9]"), "f_upper": _share(c, "[A-Z]"),
        "f_hex": _share(c, "[0-9a-fA-F]"), "f_changes": (F.length(classes) - 1) / n,
        "f_different": F.size(letters) / n, "f_entropy": entropy,
        "f_dictionary": F.coalesce("covered", F.lit(0)) / n,
        "f_depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "f_test_path": path.rlike(PATHS).cast("double"), "f_named": F.col("before").rlike(NAMES).cast("double"),
        "f_assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "f_placeholder": near.rlike(PLACEHOLDERS).cast("double")}).drop("covered")


def known_formats() -> Column:
    """A label over the columns of :func:`features`, from formats that tell.  Secrets: provider key ids
    and hexadecimal values assigned to a telling name.  None: plain numbers, placeholders, one plain word
    that is assigned, and, away from telling names, hashes, UUIDs and identifiers made of words."""
    value, bare = F.col("candidate"), (F.col("f_named") == 0) & (F.col("f_assigned") == 0)
    hexadecimal = value.rlike("^([0-9a-f]{16,64}|[0-9A-F]{16,64})$") & value.rlike("[A-Fa-f]") & value.rlike("[0-9]")
    return (F.when(value.rlike("^[0-9+/_-]+$") | value.rlike(PLACEHOLDERS), 0)
            .when(value.rlike("^AKIA[0-9A-Z]{16}$"), 1)
            .when(hexadecimal & (F.col("f_named") == 1) & (F.col("f_assigned") == 1), 1)
            .when(value.rlike("^[A-Za-z]?[a-z]+$") & (F.col("f_dictionary") == 1), 0)
            .when(bare & hexadecimal & F.length(value).isin(32, 40, 56, 64), 0)
            .when(bare & value.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), 0)
            .when(bare & (F.col("f_dictionary") >= 0.5), 0))


def score(found: DataFrame, labelled: DataFrame, max_findings: int = 20_000, trees: int = 30, depth: int = 6,
          seed: int = 10) -> DataFrame:
    """``found`` with ``score``: the forest's probability of a secret.  ``labelled``: findings with their
    features and ``label`` (1 secret, 0 none; others don't train); about ``max_findings`` of them, an
    even share by hash, train the forest."""
    own = labelled.filter(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("double"))
    kinds = {r.label: r["count"] for r in own.groupBy("label").count().collect()}
    n = sum(kinds.values())
    if len(kinds) < 2:
        return found.withColumn("score", F.lit(float(bool(kinds.get(1.0)))))
    if n > max_findings:
        part = F.pmod(F.xxhash64("id", "word_no", "place"), F.lit(1 << 20))
        own = own.filter(part < int((1 << 20) * 0.9 * max_findings / n))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="__features")
    # a bounded sample in one sorted partition: bags, and so the forest, are the same in every run
    own = own.select("label", *FEATURES)
    sample = assemble.transform(own.repartition(1).sortWithinPartitions("label", *FEATURES)).select("label", "__features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="__features", probabilityCol="__probability",
                                    rawPredictionCol="__raw", predictionCol="__prediction", numTrees=trees, maxDepth=depth,
                                    seed=seed).fit(sample)
    rows = forest.transform(assemble.transform(found))
    return rows.withColumn("score", F.round(vector_to_array("__probability")[1], 9)).select(*found.columns, "score")


def scan(docs: DataFrame, label: Column, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
         max_findings: int = 20_000) -> DataFrame:
    """(id, word_no, place, digest, length, score, is_secret) of every candidate.  ``label`` over the
    columns of :func:`features`: 1 or 0 for findings that are labelled, null for others."""
    found = common.stored(candidates(docs, doc_id, text, path), "secret-candidates")
    rows = common.stored(features(found, docs, text).withColumn("label", label), "secret-findings")
    out = score(rows, rows, max_findings)
    return out.select(F.col("id").alias(doc_id), "word_no", "place", F.sha2("candidate", 256).alias("digest"),
                      F.length("candidate").alias("length"), "score", (F.col("score") >= 0.5).alias("is_secret"))
