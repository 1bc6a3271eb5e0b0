"""Information-theoretic sanitisation.

E-mail addresses, IP addresses, card numbers and phone numbers are found by
fixed patterns; they are the protected entities. Terms near an entity are
counted over the whole corpus: among the documents with a term, the share that
has it near the entity is how strongly the term reveals the entity, and its
logarithm over the entity's own share is the information disclosed, in bits.
A term that reveals an entity too strongly, on enough different contexts, is
personal data itself wherever it stands: it is generalised, or removed if it
gives the entity away almost surely. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import register, stored, table

# The four patterns, written so that Java needs no recursion and no second try
# inside a run of characters: a match starts where the last one ended or where
# a run starts, and the repeats are possessive (nothing follows them).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "term"]
NEAR = 6          # terms on either side of an entity
CONTEXTS = 3      # different contexts that a term must share with an entity
REVEALS = 0.5     # share of a term's documents from which it discloses
SURELY = 0.9      # share from which it is removed instead of generalised
BITS = 3.0        # information that it must disclose at least
TERM_BREAK = r"[^\p{L}\p{N}]+"


def _let(value, body):
    return F.transform(F.array(value), body)[0]


def matches_of(text, pattern, some) -> F.Column:
    """(start, end, value, left, right) of the matches, leftmost first, not
    overlapping; code points, end exclusive. ``some``: a quick test that any
    exist. The stretches between the matches give their places."""
    kind = "array<struct<start:int,end:int,value:string,left:string,right:string>>"

    def build(parts, found):
        def step(a, i):
            start = a["at"] + F.char_length(parts[i])
            end = start + F.char_length(found[i])
            one = F.struct(start.alias("start"), end.alias("end"), found[i].alias("value"), parts[i].alias("left"),
                           parts[i + 1].alias("right"))
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step,
                                                     lambda a: a["out"])).otherwise(F.array().cast(kind))

    return F.when(some, _let(F.split(text, pattern, -1), lambda p: _let(
        F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: build(p, m)))).otherwise(F.array().cast(kind))


def digits(value) -> F.Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number) -> F.Column:
    def add(a, i):
        d = F.substring(number, F.length(number) - i, 1).cast("int") * (1 + i % 2)
        return a + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def base_matches(text) -> list[tuple[str, F.Column]]:
    """Kind and valid matches of the four patterns."""
    email = matches_of(text, F.lit(EMAIL), F.contains(text, F.lit("@")))
    ip = matches_of(text, F.lit(IP), text.rlike(r"[0-9]\.[0-9]++\.[0-9]"))
    card = matches_of(text, F.lit(CARD), text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"))
    phone = matches_of(text, F.lit(PHONE), F.contains(text, F.lit("+")))
    small = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (
        F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255)
    ip = F.filter(ip, lambda m: F.forall(F.split(m["value"], r"\."), small))
    card = F.filter(card, lambda m: F.length(digits(m["value"])).between(13, 19) & luhn(digits(m["value"])))
    phone = F.filter(phone, lambda m: F.length(digits(m["value"])).between(9, 15))
    return [("email", email), ("ip", ip), ("card", card), ("phone", phone)]


def terms_of(text) -> F.Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), TERM_BREAK), "")


def contexts(docs: DataFrame) -> DataFrame:
    """(entity, term, doc, context) for the terms near every entity."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def named(kind, matches):
        return F.transform(matches, lambda x: F.struct(F.lit(kind).alias("kind"), x["value"].alias("value"),
                                                       x["left"].alias("left"), x["right"].alias("right")))

    parts = [named(kind, m) for kind, m in base_matches(text)]
    found = docs.select("id", F.explode(F.concat(*parts)).alias("m"))
    value = F.when(F.col("m.kind") == "email", F.lower("m.value")).when(F.col("m.kind") == "ip", F.col("m.value")).otherwise(digits(F.col("m.value")))
    last = lambda t: F.reverse(F.slice(F.reverse(t), 1, NEAR))
    near = F.concat(last(terms_of(F.col("m.left"))), F.slice(terms_of(F.col("m.right")), 1, NEAR))
    found = found.select("id", F.concat_ws(":", F.col("m.kind"), value).alias("entity"), near.alias("near"))
    plain = F.array_distinct(F.filter("near", lambda t: (F.char_length(t) > 1) & ~t.rlike("[0-9]")))
    return found.select("entity", "id", F.xxhash64("near").alias("context"), F.explode(plain).alias("term"))


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """(term, reveals): terms that disclose an entity, and how surely. Copies of
    a context count once towards its support; shares are counted in documents."""
    near = stored(contexts(docs), "entity-contexts")
    pairs = (near.groupBy("entity", "term", "context").agg(F.count_distinct("id").alias("docs"))
             .groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("docs").alias("docs"))
             .where(F.col("contexts") >= CONTEXTS))
    # a term has at least the documents that have it near some entity, which
    # bounds its share from above: common words need not be counted further
    around = near.groupBy("term").agg(F.count_distinct("id").alias("around"))
    pairs = stored(pairs.join(around, "term").where(F.col("docs") >= REVEALS * F.col("around")).drop("around"), "entity-terms")
    entities = near.groupBy("entity").agg(F.count_distinct("id").alias("own"))
    wanted = stored(pairs.select("term").distinct(), "candidate-terms")
    # documents with a candidate, over the whole corpus; candidates are broadcast only if Spark finds the table small
    every = docs.select(F.explode(F.array_distinct(terms_of(F.coalesce("text", F.lit(""))))).alias("term"))
    with_term = every.join(wanted, "term").groupBy("term").agg(F.count("*").alias("all"))
    n = docs.count()
    scored = (pairs.join(with_term, "term").join(entities, "entity")
              .withColumn("reveals", F.least(F.lit(1.0), F.col("docs") / F.col("all")))
              .withColumn("bits", F.log2(F.col("reveals") / (F.col("own") / F.lit(float(max(n, 1)))))))
    return stored(scored.where((F.col("reveals") >= REVEALS) & (F.col("bits") >= BITS))
                  .groupBy("term").agg(F.max("reveals").alias("reveals")), "disclosing-terms")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text, base and spans: arrays of (kind, start,
    end, action); base in the order of kinds, then start, and spans with the
    disclosing terms behind it (those that overlap no base span).

    A null text is empty and has no spans; a null id is an id like others;
    repeated rows stay; an empty table gives an empty result; other columns are
    not read."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    terms = disclosing_terms(src)
    every = src.select("id", F.explode(F.array_distinct(terms_of(F.coalesce("text", F.lit(""))))).alias("term"))
    # per document, the terms it holds: a few rows, for few documents
    held = stored(every.join(terms, "term").groupBy("id").agg(
        F.sort_array(F.collect_set("term")).alias("terms"),
        F.collect_set(F.when(F.col("reveals") >= SURELY, F.col("term"))).alias("sure")), "held-terms")
    held = held.withColumnRenamed("id", "hid")
    joined = src.join(held, src["id"].eqNullSafe(F.col("hid")), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    span = "array<struct<kind:string,start:int,end:int,action:string>>"

    def named(kind, matches):
        return F.transform(matches, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                                       F.lit("generalise").alias("action"))).cast(span)

    parts = [named(kind, m) for kind, m in base_matches(text)]
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    hits = matches_of(text, pattern, F.col("terms").isNotNull())
    base = joined.select("id", "text", "terms", "sure", F.concat(*parts).alias("base"))
    more = F.filter(hits, lambda h: ~F.exists("base", lambda b: (h["start"] < b["end"]) & (b["start"] < h["end"])))
    more = F.transform(more, lambda h: F.struct(
        F.lit("term").alias("kind"), h["start"].alias("start"), h["end"].alias("end"),
        F.when(F.array_contains("sure", F.lower(h["value"])), "remove").otherwise("generalise").alias("action"))).cast(span)
    return base.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "base",
                       F.concat("base", F.coalesce(more, F.array().cast(span))).alias("spans"))


def sanitised(text, spans) -> F.Column:
    """The text with its spans replaced by their kind in brackets, or removed."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind"), s["action"].alias("action"))))

    def step(a, s):
        kept = F.when(s["start"] > a["at"], F.substring(text, a["at"] + 1, s["start"] - a["at"])).otherwise(F.lit(""))
        mark = F.when((s["action"] == "remove") | (s["start"] < a["at"]), F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], kept, mark).alias("out"))

    return F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text with personal data generalised or removed, spans."""
    found = find_personal_data(docs, id_col, text_col)
    return found.select(id_col, sanitised(F.col(text_col), F.col("spans")).alias(text_col), "spans")


def _written(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op5_pii")
def op5_pii(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:4]],
                        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _written(F.col("spans")).alias("spans"))
