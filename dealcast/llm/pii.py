"""Information-theoretic sanitisation of personal data.

1. Every whole text is searched for the four kinds of personal data (``KINDS``). Matches and
   the pieces between them give exact code-point offsets; failing matches are dropped.
2. Each value found is a protected entity. The events are the contexts of all lines: a line
   with ``AROUND`` lines before and after it, without what the patterns match, equal ones of
   a document counted once. For a term ``t`` and an entity ``e`` the corpus estimates
   ``p(e)``, ``p(t)`` and ``p(t, e)`` as shares of the events that hold them, and with them
   how much of the entity's information content the term reveals:
   ``PMI(t, e) / -log2 p(e)``, which is 1 for a term found with the entity alone.
3. Few observations say little, so ``p(t)`` is smoothed: ``SMOOTHING`` more events of the term
   are assumed for the number of different contexts of the entity's own lines that it is seen
   in. Terms whose smoothed share is at or above ``DISCLOSURE`` are spans of the kind ``term``
   in the documents that hold the entity, and are generalised to a mark like the entities
   themselves.

The one large shuffle is the word count of the corpus, pre-aggregated by every task. Joint
counts only concern lines with personal data; hot entities and terms are grouped sums, and
entities that stand in the same events are counted as one class. A context is carried once a
line, whatever the number of entities in it.

Defined cases: a null text is empty and has no spans; copies of a context are
one observation for the smoothing; rows that share doc_id and text get equal spans; other columns are ignored;
overlapping spans of different kinds are all reported and replaced as one; terms have one
letter or more, and letters inside an address are no terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.llm.arrays import let, running
from dealcast.llm.common import dropped, written

#: Kinds in reporting order. The patterns match like the plain ones (in the comments), but
#: don't try again inside a run that has failed and don't nest the repetition of groups.
KINDS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of at least 13 digits
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of a kind holds.
SIGNS = {"email": "@", "ip": ".", "phone": "+"}
TERM = "term"
LETTERS, OTHERS = r"\p{L}+", r"[^\p{L}]+"
#: Share of an entity's information that a term may reveal, and events added to a term by the smoothing.
DISCLOSURE, SMOOTHING = 0.9, 1.0
#: Lines before and after a line that belong to its context.
AROUND = 1

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: let(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # Leading zeros don't count; parts of many digits are too large whatever they say.
        return F.forall(F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+(?=.)", ""), lambda x: (F.length(x) <= 3) & (F.try_to_number(x, F.lit("999")) <= 255)))
    if kind == "card":
        return let(digits(value), lambda d: (F.length(d) <= 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, keep, kind: Column) -> Column:
    """Spans of the matches of ``pattern`` for which ``keep`` holds, with code-point offsets."""
    none = F.array().cast(f"array<{SPAN}>")

    def placed(pairs: Column) -> Column:
        at = running(F.transform(pairs, lambda x: F.length(x["before"]) + F.length(x["value"])), F.lit(0), lambda a, x: a + x)
        return F.array_compact(F.zip_with(pairs, at, lambda x, lo: F.when(keep(x["value"]), F.struct(
            kind.alias("kind"), (lo + F.length(x["before"])).alias("start"),
            (lo + F.length(x["before"]) + F.length(x["value"])).alias("end"), x["value"].alias("value"))))).cast(f"array<{SPAN}>")

    def walk(m: Column) -> Column:
        before = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        return F.when(F.size(m) == 0, none).otherwise(let(F.zip_with(before, m, lambda b, v: F.struct(b.alias("before"), v.alias("value"))), placed))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)


def personal_spans(text: Column) -> Column:
    """All valid spans of the four kinds, by kind and start."""
    return let(F.coalesce(text, F.lit("")), lambda t: F.flatten(F.array(*(
        located(t, p, lambda v, k=k: valid(k, v), F.lit(k)) for k, p in KINDS.items()))))


def terms(line: Column) -> Column:
    """Distinct lower-case words of a line."""
    return F.filter(F.array_distinct(F.split(F.lower(line), OTHERS)), lambda w: w != "")


def bare_lines(text: Column) -> Column:
    """Lines of a text without what the patterns match (no match spans two lines)."""
    bare = F.coalesce(text, F.lit(""))
    for kind, p in KINDS.items():
        bare = let(bare, lambda t: F.when(F.contains(t, F.lit(SIGNS[kind])), F.regexp_replace(t, p, " ")).otherwise(t)) \
            if kind in SIGNS else F.regexp_replace(bare, p, " ")
    return F.split(bare, "\n")


def context(lines: Column, i) -> Column:
    """Line ``i`` with the lines around it; lines outside of the text are left out."""
    return F.concat_ws("\n", *(F.when(i + k >= 0, F.get(lines, i + k)) for k in range(-AROUND, AROUND + 1)))


def firsts(values: Column) -> Column:
    """Positions of the different values of an array, one of each."""
    def of_sorted(pairs):
        return F.transform(F.filter(pairs, lambda x, k: (k == 0) | (F.get(pairs, k - 1)["v"] != x["v"])), lambda x: x["i"])

    ordered = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(values)) == F.size(values), F.transform(values, lambda _, i: i)).otherwise(let(ordered, of_sorted))


def context_terms(text: Column) -> Column:
    """Terms of each of the different contexts of a document's lines, its events.

    Every line is taken apart once; contexts are told apart by the hashes of their lines.
    """
    def around(xs, i):
        return [F.when(i + k >= 0, F.get(xs, i + k)) for k in range(-AROUND, AROUND + 1)]

    def of(lines):
        hashes = let(F.transform(lines, lambda x: F.xxhash64(x)), lambda hs: F.transform(hs, lambda _, i: F.xxhash64(*around(hs, i))))
        none = F.array().cast("array<string>")
        each = let(F.transform(lines, terms), lambda ts: F.transform(let(hashes, firsts), lambda i: F.array_distinct(
            F.concat(*(F.coalesce(x, none) for x in around(ts, i))))))
        return each

    return let(bare_lines(text), of)


def names_in(line: Column) -> Column:
    """Distinct names of the entities that stand in a line."""
    def found(kind: str, p: str) -> Column:
        values = F.filter(F.regexp_extract_all(line, F.lit(p), F.lit(0)), lambda v: valid(kind, v))
        named = F.transform(values, lambda v: F.concat(F.lit(f"{kind}:"), digits(v) if kind in ("card", "phone") else F.lower(v)))
        return F.when(F.contains(line, F.lit(SIGNS[kind])), named).otherwise(F.array().cast("array<string>")) if kind in SIGNS else named

    return F.array_distinct(F.concat(*(found(kind, p) for kind, p in KINDS.items())))


def contexts(found: DataFrame) -> DataFrame:
    """doc_id, th, i, context, own, near: the lines whose context holds an entity; found: rows with text.

    ``own`` names the entities of line ``i`` itself, ``near`` others in the lines around it. The
    names of a line are found in that line alone, so the work is linear in its length.
    """
    none = F.array().cast("array<string>")

    def near(ns, i):
        return F.array_except(F.concat(*(F.coalesce(F.when(i + k >= 0, F.get(ns, i + k)), none) for k in range(-AROUND, AROUND + 1) if k)), F.get(ns, i))

    def places(ls, ns):
        each = F.transform(ns, lambda own, i: F.struct(i.alias("i"), own.alias("own"), near(ns, i).alias("near")))
        held = F.filter(each, lambda p: F.size(p["own"]) + F.size(p["near"]) > 0)
        return F.transform(held, lambda p: F.struct(p["i"].alias("i"), context(ls, p["i"]).alias("context"), p["own"].alias("own"), p["near"].alias("near")))

    names = F.transform(F.split(F.col("text"), "\n"), names_in)
    lines = let(bare_lines(F.col("text")), lambda ls: let(names, lambda ns: places(ls, ns)))
    return found.select("doc_id", "th", F.explode(lines).alias("p")).select("doc_id", "th", "p.*", F.xxhash64("p.context").alias("c"))


def entities(lines: DataFrame) -> DataFrame:
    """doc_id, th, e, c, own, n: the events (hashes of contexts) that hold an entity.

    ``own`` tells contexts of a line that holds the entity from those of the lines around it,
    ``n`` is the number of equal rows.
    """
    def flagged(names: str, own: bool) -> Column:
        return F.transform(names, lambda e: F.struct(e.alias("e"), F.lit(own).alias("own")))

    both = F.concat(flagged("own", True), flagged("near", False))
    each = lines.select("doc_id", "th", "i", "c", F.explode(both).alias("h")).select("doc_id", "th", "i", "c", "h.e", "h.own")
    once = each.groupBy("doc_id", "th", "i", "c", "e", "own").agg(F.count(F.lit(1)).alias("n"))
    return once.groupBy("doc_id", "th", "e", "c").agg(F.max("own").alias("own"), F.max("n").alias("n"))


def classes(events: DataFrame) -> DataFrame:
    """e, cls: entities with the same events are one class, told by their number and two hashes.

    The same terms reveal all entities of a class, so a line of thousands of addresses costs
    as much as a line of one.
    """
    mark = [F.bit_xor(F.xxhash64(F.lit(k), "c", "own", "n")).alias(f"x{k}") for k in (1, 2)]
    return events.groupBy("e").agg(F.sum("n").alias("n_e"), *mark).select("e", F.struct("n_e", "x1", "x2").alias("cls"))


def revealing(docs: DataFrame, lines: DataFrame, events: DataFrame, named: DataFrame,
              disclosure: float = DISCLOSURE, smoothing: float = SMOOTHING) -> DataFrame:
    """cls, t, share: the terms that reveal the entities of a class, and how much of their information.

    events: e, c, own, n; named: e, cls.
    """
    one = named.groupBy("cls").agg(F.min("e").alias("e"))
    words_of = lines.groupBy("c").agg(F.first("context").alias("context")).select("c", terms(F.col("context")).alias("ts"))
    joint = events.join(one, "e").select("cls", "c", "own", "n").join(words_of, "c").select("cls", "own", "n", F.explode("ts").alias("t")) \
        .groupBy("cls", "t").agg(F.sum("n").alias("n_te"), F.sum(F.col("own").cast("long")).alias("seen")).where("seen > 0")
    joint = written(joint, "pii-joint")
    # The empty term stands in every event.
    every = F.flatten(F.transform(context_terms(F.col("text")), lambda ts: F.array_append(ts, F.lit(""))))
    words = docs.select(F.explode(every).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))
    asked = joint.select("t").distinct().unionByName(docs.sparkSession.createDataFrame([("",)], "t string"))
    words = written(words.join(asked, "t", "left_semi"), "pii-words")
    total = words.where("t = ''").first()
    all_events = F.lit(float(total["n_t"] if total else 1))
    n_e = F.col("cls.n_e")
    smoothed = F.col("n_t") * (1 + smoothing / F.col("seen"))
    share = F.try_divide(F.log2(F.col("n_te") * all_events / (smoothed * n_e)), F.log2(all_events / n_e))
    rows = joint.join(words, "t").withColumn("share", share)
    return rows.where(F.col("share") >= disclosure).select("cls", "t", "share")


def find(docs: DataFrame, disclosure: float = DISCLOSURE, smoothing: float = SMOOTHING) -> DataFrame:
    """doc_id, text -> doc_id, spans (kind, start, end, value), all kinds, and sanitised text of texts with spans.

    ``sanitised`` is null where nothing is to be removed.
    """
    th = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(9)).alias("th")
    base = docs.select("doc_id", th, personal_spans(F.col("text")).alias("spans"), "text")
    base = written(base.withColumn("text", F.when(F.size("spans") > 0, F.col("text"))), "pii-spans")
    hit = base.where(F.size("spans") > 0)
    lines = written(contexts(hit), "pii-contexts")
    held = written(entities(lines), "pii-entities")
    events = held.groupBy("e", "c").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
    named = written(classes(events), "pii-classes")
    told = written(revealing(docs.select("text"), lines, events, named, disclosure, smoothing), "pii-revealing")
    dropped(lines)
    # The terms of a document that reveal one of its entities; a document's own terms bound them.
    bound = held.select("doc_id", "th", "e").join(named, "e").select("doc_id", "th", "cls").distinct() \
        .join(told.select("cls").distinct(), "cls", "left_semi")
    bound = written(bound, "pii-bound").alias("b")
    same = F.col("h.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("h.th") == F.col("b.th"))
    spoken = hit.alias("h").join(bound, same, "left_semi").select("doc_id", "th", F.explode(terms(masked(F.col("text")))).alias("t")).distinct()
    wanted = spoken.alias("h").join(bound, same).select("h.doc_id", "h.th", "t", "cls").join(told, ["cls", "t"], "left_semi") \
        .groupBy("doc_id", "th").agg(F.collect_set("t").alias("terms"))
    wanted = written(wanted, "pii-terms").alias("w")
    rows = hit.alias("h").join(wanted, F.col("h.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("h.th") == F.col("w.th")), "left")
    more = F.when(F.col("w.terms").isNull(), F.array().cast(f"array<{SPAN}>")) \
        .otherwise(let(masked(F.col("h.text")), lambda t: located(t, LETTERS, lambda v: F.array_contains(F.col("w.terms"), F.lower(v)), F.lit(TERM))))
    rows = rows.select("h.doc_id", F.col("h.spans").alias("base"), F.concat("h.spans", more).alias("spans"), "h.text")
    rest = base.where(F.size("spans") == 0).select("doc_id", F.col("spans").alias("base"), "spans", "text")
    both = rows.unionByName(rest)
    return both.select("doc_id", "base", "spans", F.when(F.size("spans") > 0, sanitised(F.col("text"), F.col("spans"))).alias("sanitised"))


def masked(text: Column) -> Column:
    """Text with a line feed for every character of an address; the other kinds hold no letters."""
    p = KINDS["email"]
    return let(F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m: F.when(F.size(m) == 0, text).otherwise(F.array_join(
        F.zip_with(F.split(text, p, -1), m, lambda b, v: F.concat(b, F.coalesce(F.repeat(F.lit("\n"), F.length(v)), F.lit("")))), "")))


def sanitised(text: Column, spans: Column) -> Column:
    """Text with every span replaced by the name of its kind; overlapping spans by that of the first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def cut(chars, o):
        def upto(lo, n):
            return F.array_join(F.slice(chars, lo + 1, n), "")

        at = running(F.transform(o, lambda s: s["end"]), F.lit(0), lambda a, x: F.greatest(a, x))
        marks = F.zip_with(o, at, lambda s, a: F.when(s["start"] >= a, F.concat(upto(a, s["start"] - a), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        end = F.array_max(F.transform(o, lambda s: s["end"]))
        return F.concat(F.array_join(marks, ""), let(end, lambda e: upto(e, F.size(chars))))

    return let(F.split(text, ""), lambda chars: let(order, lambda o: cut(chars, o)))


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
