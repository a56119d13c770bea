"""Personal data by bootstrapped contextual extraction (operator 7), with DataFrame functions only.

Seeds: spans of fixed forms (e-mail, IP address, payment card, phone), found in every whole text and
checked (octets, Luhn, digit counts). Every match of a form is one row with the length of the text since
the last match of that form; a running sum over the matches of a text gives its place, so the work is
linear in the matches. Unlabelled instances are runs of letters and digits (joined by single - . _ /) with
at least four digits that no seed overlaps. Around them:
  1. lexical patterns: the unit before an instance (letters and digits with a following : = or #), the two
     units before it, and the unit behind it, all in lower case and found in the whole text, whatever
     stands between (spaces, brackets, quotes, another instance). Units of over UNIT_CHARS are no patterns,
     nor those further than CONTEXT characters away;
  2. a pattern's precision is the share of all its occurrences in the corpus (units and pairs of units of
     every text) that stand at a known identifier; it needs MIN_SUPPORT different identifiers and
     MIN_PRECISION;
  3. an instance's score is the noisy-or of its patterns' precisions; instances that reach MIN_SCORE
     become known identifiers, which raises the precision of other patterns; ROUNDS rounds;
  4. every unlabelled instance whose text is then known is returned as a span of kind `id`.
Patterns and instances meet in aggregations and equi-joins on the pattern or the text; nothing is
collected. Only units of patterns with MIN_SUPPORT different instances are counted: joined before the
count if these are few enough to broadcast, behind it if not.

Spans are in code points, ends exclusive. Defined results: null or empty text has no spans; a null
doc_id is carried; repeated rows are returned each; spans of two kinds that start alike are ordered by
kind; an empty table gives no rows; other columns are ignored. Very long texts: a task holds one text and
the pieces between its matches, and one text's spans are sorted and grouped together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import drop_table, materialize, read_table
from .phrases import identified, keyed_rows

KINDS = ("email", "ip", "card", "phone", "id")
ID = 4
MIN_SUPPORT = 5
MIN_PRECISION = 0.5
MIN_SCORE = 0.5
ROUNDS = 3
CONTEXT = 64
UNIT_CHARS = 32
#: So many patterns (of at most 2 * UNIT_CHARS + 4 characters) are broadcast to the units; more are joined behind the count.
BROADCAST_PATTERNS = 50_000
#: Code points of the pieces in which texts are redacted.
PIECE = 4096

#: The contract's patterns. They may start at the head of a run only, or where the last match ended,
#: and never give back what they took: the same matches, in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Maximal chains of digits with single separators; those of fewer than 14 or more than 19 digits fail anyway.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
LETTER, OTHER = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]"
_INNER = rf"(?:[\p{{L}}\p{{N}}&&[^0-9]]|[-._/](?={LETTER}))*+"
TOKEN = rf"(?<!{LETTER})(?<!{LETTER}[-._/])(?={LETTER}){_INNER}(?:[0-9]{_INNER}){{4,}}+"
UNIT = rf"{LETTER}+[:=#]?"
_SHORT = rf"{LETTER}{{1,{UNIT_CHARS}}}+(?!{LETTER})[:=#]?+"
LEFT_ONE = rf"(?s){OTHER}({_SHORT}){OTHER}*\z"
LEFT_TWO = rf"(?s){OTHER}({_SHORT}){OTHER}*({_SHORT}){OTHER}*\z"
RIGHT_ONE = rf"(?s)\A{OTHER}+({_SHORT})."


def _sql(pattern: str) -> str:
    return "r'" + pattern + "'"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the Luhn check."""
    d = f"cast(substring({digits}, length({digits}) - i, 1) as int)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (a, i) -> a + IF(i % 2 = 0, {d}, IF({d} > 4, 2 * {d} - 9, 2 * {d}))) % 10 = 0"


def _pieces(k: int, pattern: str, possible: str) -> str:
    """SQL: an array with a struct for each piece of a text between matches of a form, and the match f behind the piece."""
    p = _sql(pattern)
    piece = f"named_struct('k', {k}, 'f', f, 'gap', length(p), 'head', left(p, {CONTEXT}), 'tail', right(p, {CONTEXT}))"
    return f"coalesce(CASE WHEN {possible} THEN transform(zip_with(regexp_extract_all(text, {p}, 0), split(text, {p}, -1), (f, p) -> {piece}), (x, i) -> named_struct('i', i, 'x', x)) END, array())"


def instances(rows: DataFrame) -> DataFrame:
    """(did, th, s, k, e, f, patterns) of every seed (k under ID) and unlabelled instance (k = ID) of every row.

    patterns is empty for a seed that starts inside another one, so that no occurrence counts twice.
    """
    digit = "rlike(text, '[0-9]')"
    forms = ((EMAIL, "instr(text, '@') > 0"), (IP, f"instr(text, '.') > 0 AND {digit}"), (CARD, digit), (PHONE, "instr(text, '+') > 0"), (TOKEN, digit))
    found = F.expr(f"concat({', '.join(_pieces(k, *form) for k, form in enumerate(forms))})")
    m = rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "did", "th", F.explode(found).alias("x")).select("uid", "did", "th", "x.i", "x.x.*")
    m = m.where("f is not null or i > 0")  # texts without a match are one piece
    order = W.partitionBy("uid", "k").orderBy("i")
    m = m.repartition("uid").select(
        "uid", "did", "th", "k", "f", "gap", "tail",
        F.sum(F.col("gap") + F.coalesce(F.length("f"), F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int").alias("e"),
        F.lag("f").over(order).alias("pf"), F.lead("gap").over(order).alias("ng"), F.lead("head").over(order).alias("nh"), F.lead("f").over(order).alias("nf"),
    )
    valid = f"""CASE k WHEN 1 THEN rlike(f, r'^{OCTET}\\.{OCTET}\\.{OCTET}\\.{OCTET}$') WHEN 2 THEN {luhn("regexp_replace(f, '[ -]', '')")}
        WHEN 3 THEN length(regexp_replace(f, '[^0-9]', '')) BETWEEN 10 AND 15 ELSE true END"""
    m = m.where("f is not null").where(F.expr(valid)).withColumn("s", F.col("e") - F.length("f"))
    seed = F.col("k") < ID
    text = W.partitionBy("uid")
    before = F.max(F.when(seed, F.col("e"))).over(text.orderBy("s", "k").rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(seed, F.col("s"))).over(text.orderBy(F.desc("s"), F.desc("k")).rowsBetween(W.unboundedPreceding, -1))
    m = m.withColumn("inside", F.coalesce(before > F.col("s"), F.lit(False))).withColumn("over", F.coalesce(after < F.col("e"), F.lit(False)))
    m = m.where(seed | ~(F.col("inside") | F.col("over")))
    left = f"lower(IF(gap > {CONTEXT}, tail, concat(' ', IF(pf IS NULL, '', IF(length(pf) > {CONTEXT}, right(pf, {CONTEXT}), pf)), tail)))"
    right = f"lower(IF(ng > {CONTEXT}, nh, concat(nh, coalesce(left(nf, {CONTEXT}), ' '))))"
    m = m.select("did", "th", "s", "k", "e", "f", F.col("inside"), F.expr(left).alias("l"), F.expr(right).alias("r"))
    glued = f"rlike(l, r'{LETTER}\\z') AND rlike(f, r'\\A{LETTER}')"
    two = f"concat('B', regexp_extract(l, {_sql(LEFT_TWO)}, 1), ' ', regexp_extract(l, {_sql(LEFT_TWO)}, 2))"
    patterns = f"""IF(inside, array(), filter(array(IF({glued}, '', concat('L', regexp_extract(l, {_sql(LEFT_ONE)}, 1))), IF({glued}, '', {two}),
        concat('R', regexp_extract(r, {_sql(RIGHT_ONE)}, 1))), x -> length(x) > 2 OR length(x) = 2 AND x <> 'B '))"""
    return m.select("did", "th", "s", "k", "e", "f", F.expr(patterns).alias("patterns"))


def unit_counts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(u, occurrences) of the units and pairs of successive units in wanted (u), over all rows."""
    units = f"regexp_extract_all(lower(text), {_sql(UNIT)}, 0)"
    pairs = "zip_with(us, slice(us, 2, greatest(size(us) - 1, 0)), (a, b) -> concat(a, ' ', b))"  # the last has no second: null
    words = rows.select(F.expr(units).alias("us")).select(F.explode(F.expr(f"concat(us, {pairs})")).alias("u"))
    count = F.count("*").alias("occurrences")
    if wanted.limit(BROADCAST_PATTERNS + 1).count() <= BROADCAST_PATTERNS:
        return words.join(F.broadcast(wanted), "u", "left_semi").groupBy("u").agg(count)
    return words.groupBy("u").agg(count).join(wanted, "u", "left_semi")


def bootstrap(found: DataFrame, rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(f): texts of unlabelled instances that high-confidence patterns vouch for. found: instances() of rows."""
    edges = found.select(F.explode("patterns").alias("w"), "f", (F.col("k") < ID).alias("seed")).groupBy("w", "f").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    edges = materialize(edges, "pii-edges")
    wanted = materialize(edges.groupBy("w").agg(F.count("*").alias("m")).where(F.col("m") >= MIN_SUPPORT).select("w", F.expr("substring(w, 2)").alias("u")), "pii-wanted")
    counts = unit_counts(rows, wanted.select("u").distinct())
    counts = materialize(wanted.join(counts, "u").select("w", "occurrences"), "pii-counts")
    graph = materialize(edges.join(counts, "w"), "pii-graph")  # counts is a plain table: broadcast if small, else Spark can split a hot pattern
    known = materialize(edges.where("seed").select("f").distinct(), "pii-known")
    for _ in range(rounds):
        labelled = graph.join(known, "f", "left_semi")
        patterns = labelled.groupBy("w").agg(F.sum("n").alias("hits"), F.count("*").alias("support"), F.first("occurrences").alias("occurrences"))
        patterns = patterns.withColumn("precision", F.least(F.lit(0.99), F.col("hits") / F.col("occurrences"))).where((F.col("support") >= MIN_SUPPORT) & (F.col("precision") >= MIN_PRECISION))
        patterns = materialize(patterns.select("w", "precision"), "pii-patterns")
        scored = graph.join(patterns, "w").groupBy("f").agg((1 - F.exp(F.sum(F.log(1 - F.col("precision"))))).alias("score"))
        old, known = known, materialize(known.union(scored.where(F.col("score") >= MIN_SCORE).select("f")).distinct(), "pii-known")
        drop_table(old)
        drop_table(patterns)
    out = materialize(known.join(edges.where("NOT seed").select("f").distinct(), "f"), "pii-found")
    for table in (edges, wanted, counts, graph, known):
        drop_table(table)
    return out


def span_rows(docs: DataFrame) -> DataFrame:
    """(did, th, s, k, e): the spans of every text that has any, seeds and discovered identifiers."""
    rows = identified(docs)
    found = materialize(instances(rows), "pii-instances")
    known = bootstrap(found, rows)
    seeds = found.where(F.col("k") < ID)
    return seeds.select("did", "th", "s", "k", "e").union(found.where(F.col("k") == ID).join(known, "f").select("did", "th", "s", "k", "e"))


def all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, did, th, base and spans of every row: sorted (s, k, e) of the seeds, and of seeds and discovered identifiers."""
    spans = span_rows(docs).groupBy("did", "th").agg(F.array_sort(F.collect_set(F.struct("s", "k", "e"))).alias("spans"))
    spans = materialize(spans, "pii-spans")  # a plain table, so that Spark can split a hot text
    none = "cast(array() as array<struct<s:int,k:int,e:int>>)"
    out = identified(docs).drop("text").join(spans, ["did", "th"], "left").withColumn("spans", F.expr(f"coalesce(spans, {none})"))
    return out.select("doc_id", "did", "th", F.expr(f"filter(spans, x -> x.k < {ID})").alias("base"), "spans")


def span_text(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', element_at({names}, x.k + 1), x.s, x.e)), ',')")


def masked_texts(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(did, th, masked) of the texts with spans; overlapping spans are replaced together, by the kind of the first.

    rows: did, th, text. Texts are taken apart into pieces of PIECE code points, masked piece by piece.
    """
    text = W.partitionBy("did", "th").orderBy("s", "k", "e")
    past = text.rowsBetween(W.unboundedPreceding, -1)
    spans = spans.distinct().withColumn("new", F.coalesce((F.col("s") >= F.max("e").over(past)).cast("int"), F.lit(1)))
    spans = spans.withColumn("c", F.sum("new").over(text.rowsBetween(W.unboundedPreceding, 0)))
    runs = spans.groupBy("did", "th", "c").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("k", F.struct("s", "k")).alias("k"))
    runs = materialize(runs, "pii-runs")
    parts = runs.select("did", "th", F.explode(F.expr(f"sequence(s div {PIECE}, (e - 1) div {PIECE})")).alias("pos"), F.struct("s", "e", "k").alias("x"))
    parts = parts.groupBy("did", "th", "pos").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    texts = rows.join(runs.select("did", "th").distinct(), ["did", "th"], "left_semi").dropDuplicates(["did", "th"])
    pieces = texts.select("did", "th", F.posexplode(F.expr(f"regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0)")).alias("pos", "piece"))
    pieces = pieces.withColumn("pos", F.col("pos").cast("long")).join(parts, ["did", "th", "pos"], "left")
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    begin = f"int(greatest(x.s - pos * {PIECE}, 0))"
    last = f"IF(i = 0, 0, int(xs[i - 1].e - pos * {PIECE}))"
    parts_of = f"transform(xs, (x, i) -> concat(substring(piece, {last} + 1, {begin} - {last}), IF(x.s >= pos * {PIECE}, element_at({names}, x.k + 1), '')))"
    masked = f"IF(xs IS NULL, piece, concat(array_join({parts_of}, ''), substring(piece, int(element_at(xs, -1).e - pos * {PIECE}) + 1)))"
    pieces = pieces.select("did", "th", "pos", F.expr(masked).alias("piece"))
    whole = pieces.groupBy("did", "th").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("ps"))
    return whole.select("did", "th", F.expr("array_join(ps.piece, '')").alias("masked"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of personal data replaced by its kind in brackets; the columns of docs stay."""
    masked = materialize(masked_texts(identified(docs).select("did", "th", "text"), span_rows(docs)), "pii-masked")
    rows = keyed_rows(docs).join(masked, ["did", "th"], "left")
    out = {"text": F.coalesce("masked", "row.text").alias("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("masked").isNotNull(), F.length("masked")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.select(*(out.get(c, F.col(f"row.`{c}`")) for c in docs.columns))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_spans(read_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.k = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return rows.select("doc_id", *counts, F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"), span_text("spans").alias("spans"))
