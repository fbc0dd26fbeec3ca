"""Personal data by fixed patterns, widened by bootstrapped contextual extraction.

Seeds are the entities that the base patterns find.  The two words before an
entity are its lexical pattern.  Patterns and instances (the identifier-like
strings of the corpus) form a bipartite graph, which Spark scores in rounds: a
pattern is as good as the share of its occurrences in the whole corpus that
precede a trusted instance, and an instance is as good as the patterns it
occurs with.  What good patterns precede is trusted in the next round, and may
support patterns that no seed did; rounds end when no trust grows any more.
All mentions of instances trusted then are added to the base spans.

Only DataFrame functions are used.  Texts are read to find mentions, and once
more in each round that brings new patterns, to count how often these occur;
they are never moved.  A text with b base
spans and c identifier-like strings takes b * c comparisons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import shared_dir, stored, table

#: Kinds in order, with patterns that match just what the plain ones do, leftmost and longest, without trying a place again
#: from the middle of a run: `++` gives nothing back, and `\G` is where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: Identifier-like: a string between white space, of five characters at least, that has two digits or at signs.
LIKE = r"(?<!\S)(?=\S{5})[^\s0-9@]*+[0-9@][^\s0-9@]*+[0-9@]\S*+"
EDGE = r"""["'()\[\]{}<>,.;:!?=]"""
#: Characters of a discovered identifier; digits and at signs it has at least; characters before a mention that are looked at
#: first for its pattern (where two whole words don't lie in them, all of the text before it is).
LEAST_CHARS, LEAST_DIGITS, CONTEXT = 5, 2, 200
#: Distinct trusted instances that a pattern needs; confidence from which patterns and instances are trusted.
SUPPORT, TRUST = 3, 0.5
#: Rounds end when the trust of all instances together grows by less than this, so that no single one does by more.
SETTLED = 1e-3
#: Patterns up to which they are sent to every executor to count them; more are joined by shuffling.
MOST_PATTERNS = 1_000_000
#: Shares of the documents of which one is counted before the others.
SHARES = 16
#: Cells of the table that says which word pairs may be patterns.
CELLS = 1 << 16


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _placed(df: DataFrame, text: Column, names: list[str], keep: list[str]) -> DataFrame:
    """Turns __m_x (matches) and __p_x (what lies before, between and after them) into __x: array of (start, end, value, before).

    before has the last two words of what precedes the match in the text; it is empty where there aren't two.  Places are code points, end exclusive.  Running totals come in two steps, of
    runs of about sqrt(n) matches and within a run, so that a text with very
    many matches takes n sqrt(n) steps and not n squared.
    """
    c = F.col

    def run(x: str) -> Column:
        return F.ceil(F.sqrt(F.size(f"__m_{x}") + 1)).cast("int")

    def sums(x: str) -> Column:
        return F.transform(F.sequence(F.lit(0), c(f"__r_{x}")), lambda j: _sum(F.slice(f"__l_{x}", j * c(f"__r_{x}") + 1, c(f"__r_{x}"))))

    def offsets(x: str) -> Column:
        return F.transform(f"__s_{x}", lambda _, j: _sum(F.slice(f"__s_{x}", F.lit(1), j)))

    def places(x: str) -> Column:
        def one(m: Column, i: Column) -> Column:
            j = F.floor(i / c(f"__r_{x}")).cast("int")
            piece = F.get(c(f"__p_{x}"), i)
            start = F.get(c(f"__o_{x}"), j) + _sum(F.slice(f"__l_{x}", j * c(f"__r_{x}") + 1, i - j * c(f"__r_{x}"))) + F.length(piece)
            near = [F.coalesce(F.get(c(f"__{a}_{x}"), i - d), F.lit("")) for a, d in (("m", 2), ("p", 1), ("m", 1))]
            # read backwards, an expression for the last two words is tried at one place only
            short = F.regexp_extract(F.reverse(F.right(F.concat(*near, piece), F.lit(CONTEXT))), r"^\s*+\S++\s++\S++(?=\s)", 0)
            whole = F.regexp_extract(F.reverse(F.substring(text, F.lit(1), start.cast("int"))), r"^\s*+\S++\s++\S++", 0)
            before = F.reverse(F.when(short != "", short).otherwise(whole))
            return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"), before.alias("before"))

        return F.transform(f"__m_{x}", one)

    lengths = [F.zip_with(F.slice(f"__p_{x}", F.lit(1), F.size(f"__m_{x}")), f"__m_{x}", lambda p, m: (F.length(p) + F.length(m)).cast("long")).alias(f"__l_{x}") for x in names]
    df = df.select("*", *lengths, *(run(x).alias(f"__r_{x}") for x in names))
    df = df.select("*", *(sums(x).alias(f"__s_{x}") for x in names))
    df = df.select("*", *(offsets(x).alias(f"__o_{x}") for x in names))
    return df.select(*keep, *(places(x).alias(f"__{x}") for x in names))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        digits = F.regexp_replace(value, "[^0-9]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def with_base(df: DataFrame, text: str, out: str, candidates: str | None = None) -> DataFrame:
    """df with `out`: array of (start, rank, end, value, before) of the base patterns, by start, then kind as listed.

    rank is the kind's place in KINDS.  With `candidates`, a column of that name has
    identifier-like strings (start, end, value, before) that touch no base span.
    """
    keep = df.columns
    t = F.coalesce(F.col(text), F.lit(""))
    hints = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+"))}
    none = F.array().cast("array<string>")
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)) | ({"like": LIKE} if candidates else {})
    found = []
    for kind, pattern in patterns.items():
        matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        found.append((F.when(hints[kind], matches).otherwise(none) if kind in hints else matches).alias(f"__m_{kind}"))
    cut = df.select("*", *found)
    cut = cut.select("*", *(F.when(F.size(f"__m_{k}") > 0, F.split(t, p, -1)).otherwise(none).alias(f"__p_{k}") for k, p in patterns.items()))
    placed = _placed(cut, t, list(patterns), keep)

    def ranked(rank: int, kind: str) -> Column:
        good = F.filter(f"__{kind}", lambda x: _valid(kind, x["value"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), x["value"].alias("value"), x["before"].alias("before")))

    based = placed.withColumn(out, F.array_sort(F.concat(*(ranked(i, k) for i, k in enumerate(KINDS)))))
    if not candidates:
        return based.select(*keep, out)

    def core(x: Column) -> Column:
        lead = F.length(F.regexp_extract(x["value"], f"^{EDGE}*", 0))
        trail = F.length(F.regexp_extract(x["value"], f"{EDGE}*$", 0))
        size = F.length(x["value"]) - lead - trail
        value = F.substring(x["value"], lead + 1, F.greatest(size, F.lit(0)))
        return F.struct((x["start"] + lead).alias("start"), (x["end"] - trail).alias("end"), value.alias("value"), x["before"].alias("before"))

    cored = based.select(*keep, out, F.transform("__like", core).alias("__like"))
    large = F.filter("__like", lambda x: (F.length(x["value"]) >= LEAST_CHARS) & (F.length(F.regexp_replace(x["value"], "[^0-9@]", "")) >= LEAST_DIGITS))
    free = F.filter(large, lambda x: ~F.exists(out, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return cored.select(*keep, out, free.alias(candidates))


def normal(words: Column) -> Column:
    """Lower case; digits count alike."""
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def pattern_of(before: Column) -> Column:
    """The last two words of what precedes a mention, as one string; null where there are fewer."""
    found = F.regexp_extract(before, r"(\S++)\s++(\S++)\s*+$", 0)
    return F.when(found != "", F.regexp_replace(normal(F.trim(F.regexp_replace(found, r"\s++", " "))), r"^\s|\s$", ""))


def _key(pattern: Column) -> Column:
    return F.xxhash64(pattern)


def mentions(docs: DataFrame, path: str, key: str, text: str) -> DataFrame:
    """Stored: k, th, base (spans), candidates; a row for each row of docs."""
    base = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    return stored(with_base(base, "text", "base", "candidates").select("k", "th", "base", "candidates"), f"{path}/mentions")


def _cells(patterns: DataFrame) -> DataFrame:
    """One row: an array of CELLS booleans, true where some pattern has its key in that cell."""
    used = patterns.select(F.pmod("pattern", F.lit(CELLS)).alias("cell"), F.lit(True).alias("used")).distinct()
    every = patterns.sparkSession.range(CELLS).withColumnRenamed("id", "cell").join(used, "cell", "left")
    both = F.struct("cell", F.coalesce("used", F.lit(False)).alias("used"))
    return every.agg(F.transform(F.array_sort(F.collect_list(both)), lambda x: x["used"]).alias("cells"))


def occurrences(docs: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """(pattern, n): how often each of the given patterns occurs, followed by a word, in all texts of docs.

    Word pairs whose cell no pattern uses are dropped inside the row (a table of fixed size, so it may be
    broadcast); only the others become rows and are looked up.
    """
    words = F.split(normal(F.coalesce(F.col(text), F.lit(""))), r"\s++")
    n = F.size("w") - 2
    pairs = F.when(n > 0, F.zip_with(F.slice("w", F.lit(1), n), F.slice("w", F.lit(2), n), lambda a, b: _key(F.concat(a, F.lit(" "), b))))
    keyed = docs.select(words.alias("w")).select(pairs.alias("p")).join(F.broadcast(_cells(patterns)))
    every = keyed.select(F.explode(F.filter("p", lambda x: F.get(F.col("cells"), F.pmod(x, F.lit(CELLS)).cast("int")))).alias("pattern"))
    few = patterns.limit(MOST_PATTERNS + 1).count() <= MOST_PATTERNS
    wanted = patterns.select("pattern")
    return every.join(F.broadcast(wanted) if few else wanted, "pattern").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def totals(docs: DataFrame, text: str, patterns: DataFrame, path: str) -> DataFrame:
    """(pattern, n) over all texts for every pattern (pattern, most) that can still reach the confidence TRUST.

    One share of the documents is counted first.  Its counts are lower bounds:
    a pattern that occurs there more than most / TRUST times, most being how
    many mentions follow it in the corpus, is out whatever the rest holds.
    Those left, mostly few, are counted in the rest.
    """
    share = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(SHARES))
    first = stored(patterns.join(occurrences(docs.where(share == 0), text, patterns), "pattern", "left").select("pattern", F.coalesce("n", F.lit(0)).alias("n0"), "most"), f"{path}/first")
    able = stored(first.where(F.col("most") >= TRUST * F.col("n0")), f"{path}/able")
    rest = occurrences(docs.where(share != 0), text, able)
    return able.join(rest, "pattern", "left").select("pattern", (F.col("n0") + F.coalesce("n", F.lit(0))).alias("n")).where("n > 0")


def discovered(docs: DataFrame, found: DataFrame, path: str, text: str) -> DataFrame:
    """(k, th, rank, start, end) of mentions outside the base spans whose instance is trusted at the end.

    Edges of the graph are counted before they are scored, so that a pattern or an
    instance that many mentions share is a number in a row, not a group of rows.
    """
    seeds = found.select("k", "th", F.explode("base").alias("m")).select("k", "th", "m.start", "m.end", "m.rank", "m.value", "m.before")
    others = found.select("k", "th", F.explode("candidates").alias("m")).select("k", "th", "m.start", "m.end", F.lit(-1).alias("rank"), "m.value", "m.before")
    every = seeds.unionByName(others).select("k", "th", "start", "end", "rank", F.xxhash64(F.lower("value")).alias("instance"), _key(pattern_of(F.col("before"))).alias("pattern"), pattern_of(F.col("before")).isNotNull().alias("has"))
    every = stored(every, f"{path}/every")
    edges = every.where("has").groupBy("pattern", "instance", "rank").agg(F.count(F.lit(1)).alias("n"))
    edges = stored(edges, f"{path}/edges")
    most = stored(edges.groupBy("pattern").agg(F.sum("n").alias("most")), f"{path}/most")
    seeds_only = stored(edges.where("rank >= 0").groupBy("instance").agg(F.max("rank").alias("rank")).withColumn("trust", F.lit(1.0)), f"{path}/trust0")
    learnt = seeds_only.limit(0)
    trust, before, k = seeds_only, 0.0, 0
    asked, total = most.select("pattern").limit(0), most.select("pattern", F.col("most").alias("n")).limit(0)
    while True:
        k += 1
        known = edges.drop("rank").join(trust, "instance")
        good = known.groupBy("pattern", "rank").agg(F.sum(F.col("trust") * F.col("n")).alias("weight"), F.count_distinct("instance").alias("support"))
        good = good.groupBy("pattern").agg(F.sum("weight").alias("weight"), F.sum("support").alias("support"), F.max(F.struct("weight", "rank"))["rank"].alias("rank"))
        good = stored(good.where(F.col("support") >= SUPPORT), f"{path}/good{k}")
        fresh = stored(good.select("pattern").join(asked, "pattern", "left_anti").join(most, "pattern"), f"{path}/fresh{k}")
        if not fresh.isEmpty():
            total = stored(total.unionByName(totals(docs, text, fresh, f"{path}/round{k}")), f"{path}/total{k}")
            asked = stored(asked.unionByName(fresh.select("pattern")), f"{path}/asked{k}")
        scored = good.join(total, "pattern").select("pattern", "rank", F.least(F.lit(1.0), F.col("weight") / F.col("n")).alias("confidence"))
        scored = scored.where(F.col("confidence") >= TRUST)
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        new = edges.where("rank < 0").select("pattern", "instance").distinct().join(scored, "pattern").groupBy("instance").agg((1 - doubt).alias("trust"), F.max(F.struct("confidence", "rank"))["rank"].alias("rank"))
        new = new.join(seeds_only.select("instance"), "instance", "left_anti").select("instance", "rank", "trust")
        # trust only grows, and has a bound, so rounds come to an end
        best = F.max(F.struct("trust", "rank"))
        learnt = stored(learnt.unionByName(new).groupBy("instance").agg(best.alias("b")).select("instance", "b.rank", "b.trust"), f"{path}/trust{k}")
        trust = seeds_only.unionByName(learnt)
        now = learnt.agg(F.coalesce(F.sum("trust"), F.lit(0.0))).first()[0]
        if now - before < SETTLED:
            break
        before = now
    late = trust.where(F.col("trust") >= TRUST).select("instance", F.col("rank").alias("as"))
    return every.where("rank < 0").join(late, "instance").select("k", "th", F.col("as").alias("rank"), "start", "end")


def _name(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), rank + 1)


def joined(spans: Column) -> Column:
    """kind:start:end of spans in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _name(s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: k, th, base and spans (arrays of (start, rank, end), by start, then kind).

    A null text counts as empty and has no spans; null keys are kept; rows equal in key and
    text get the same spans; where nothing is learnt, spans equals base.  An empty table gives no rows.
    """
    found = mentions(docs, path, key, text)
    span = F.struct("start", F.col("rank").cast("int").alias("rank"), "end")
    added = discovered(docs, found, path, text).select("k", "th", span.alias("span")).groupBy("k", "th").agg(F.collect_set("span").alias("added"))
    added = stored(added, f"{path}/added").select(F.col("k").alias("ak"), F.col("th").alias("ath"), "added")
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end")))
    rows = found.select("k", "th", base.alias("base")).join(added, F.col("k").eqNullSafe(F.col("ak")) & (F.col("th") == F.col("ath")), "left")
    return rows.select("k", "th", "base", F.array_sort(F.concat("base", F.coalesce("added", F.slice("base", F.lit(1), F.lit(0))))).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first gives the kind."""

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(F.lit(0), (s["start"] - acc["at"]).cast("int")))
        out = F.when(clear, F.concat(acc["out"], gap, F.lit("["), F.upper(_name(s["rank"])), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"), shared_dir(spark))
    counts = [F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(F.col("k").alias("doc_id"), *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _is(rank: int):
    return lambda s: s["rank"] == rank
