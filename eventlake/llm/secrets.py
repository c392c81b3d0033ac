"""Secret scans: fixed patterns, and a randomness test battery for other tokens.

Everything here is DataFrame functions. Three kinds have fixed patterns. Besides, each
long run of token characters gets an encoding by the characters it uses, and its
characters, as numbers of that encoding, go through three tests of randomness: chi-squared
uniformity over the alphabet, runs above and below the middle, and correlation
with the next character. A token is reported as ``random`` if

- the battery does not reject that it is random: Fisher's method over the three p-values
  stays above ``reject``; and
- it is too even for a word: words draw letters unevenly, so their chi-squared statistic
  follows a noncentral law whose centre grows with their length. The p-value of a
  statistic this low has to pass a Benjamini-Hochberg step over all tokens of the
  same length band in the whole corpus. In hex and base32 that statistic hardly tells
  words from random tokens; there the changes between letters and digits count, of which a
  name or number has about one in twenty characters, and both have bands of their own. Bands keep the many short words from
  lending their weight to, or taking it from, the few long tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import scan_array, text_or_empty

#: The patterns of the three kinds, and the least length of a match
#: (of group 2 for ``assign``).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
#: ``{16,}`` and ``{24,}`` find what ``+`` finds less the matches that are too short:
#: runs are maximal, so a short one holds no long one.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "random")
SPAN = "struct<start:int,end:int,kind:int,value:string>"


@dataclass(frozen=True)
class Battery:
    """``least``: length from which the tests can tell words from random tokens.
    ``rate``: share of false discoveries. ``reject``: level at which a token is not
    random. ``repeat``: chance that two letters of natural text are equal (English
    0.0667, French 0.0746, German 0.0762, Spanish 0.0775; the lowest is the strictest).
    ``changes``: changes between letters and digits for each character of a name or number.
    """

    least: int = 20
    rate: float = 0.01
    reject: float = 0.001
    repeat: float = 0.0667
    changes: float = 0.05


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern with their places in code points.

    ``split`` gives what lies between the matches, so places are running sums.
    """
    between = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(between, 1, F.size(hits)).alias("gap"), hits.alias("hit"))

    def step(at, x):
        start = at + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return F.struct(
            end.alias("state"),
            F.array(
                F.struct(
                    start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["hit"].alias("value")
                )
            ).alias("outs"),
        )

    found = scan_array(pairs, F.lit(0), step, SPAN)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


#: Encodings by rising size, the characters that show them, their alphabets.
ENCODINGS = (
    ("decimal", r"^[0-9]+=*$", "0123456789"),
    ("hex", r"^[0-9a-f]+=*$", "0123456789abcdef"),
    ("hex_upper", r"^[0-9A-F]+=*$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", r"^[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64_url", r"^[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def _chosen(value: Column, pick) -> Column:
    case = F.when(value.rlike(ENCODINGS[0][1]), pick(ENCODINGS[0]))
    for e in ENCODINGS[1:]:
        case = case.when(value.rlike(e[1]), pick(e))
    return case


def _upper_tail(z: Column) -> Column:
    """Chance of a normal variate above ``z``, by a fixed rational formula (error under
    1e-7, public domain: Abramowitz and Stegun 26.2.17); for large z by the tail's series."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / 2.5066282746310002
    tail = density * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _at_least(x: Column, mean: Column) -> Column:
    """Chance of ``x`` or more from a Poisson law; the normal law for large means."""
    zero = F.struct(F.exp(-mean).alias("term"), F.lit(0.0).alias("sum"))

    def step(a, i):
        return F.struct((a["term"] * mean / i).alias("term"), (a["sum"] + a["term"]).alias("sum"))

    less = F.aggregate(F.sequence(F.lit(1), x.cast("int")), zero, step)["sum"]
    few = F.when(x < 1, F.lit(1.0)).otherwise(F.greatest(F.lit(1e-15), 1 - less))
    return F.when(mean > 50, _upper_tail((x - mean) / F.sqrt(mean))).otherwise(few)


def _tests(value: Column, battery: Battery) -> Column:
    """The battery for one token: struct(n, encoding, p_random, p_word)."""
    body = F.rtrim(value, F.lit("="))
    alphabet = _chosen(value, lambda e: F.lit(e[2]))
    base = F.struct(
        F.split(body, "").alias("chars"), alphabet.alias("abc"),
        _chosen(value, lambda e: F.lit(e[0])).alias("encoding"), body.alias("body"),
    )

    def counts(b):
        codes = F.transform(b["chars"], lambda c: F.instr(b["abc"], c) - 1)
        squares = F.aggregate(
            F.array_distinct(b["chars"]),
            F.lit(0.0),
            lambda a, c: a + F.pow(F.char_length(b["body"]) - F.char_length(F.replace(b["body"], c, F.lit(""))), F.lit(2)),
        )
        k = F.char_length(b["abc"]).cast("double")
        mid = (k - 1) / 2
        # The last digit of hex, the last letter of base32.
        cut = F.when(k == 16, F.lit(9.0)).otherwise(F.lit(25.0))
        zero = F.struct(
            F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"),
            F.lit(0.0).alias("products"), F.lit(0.0).alias("changes"),
        )

        def step(a, v):
            v = v.cast("double")
            changed = (a["last"] >= 0) & ((a["last"] > cut) != (v > cut))
            turned = (a["last"] < 0) | ((a["last"] > mid) != (v > mid))
            return F.struct(
                v.alias("last"),
                (a["runs"] + turned.cast("double")).alias("runs"),
                (a["high"] + (v > mid).cast("double")).alias("high"),
                (a["products"] + F.when(a["last"] < 0, F.lit(0.0)).otherwise((a["last"] - mid) * (v - mid))).alias("products"),
                (a["changes"] + changed.cast("double")).alias("changes"),
            )

        return F.struct(
            b["encoding"].alias("encoding"), F.size(b["chars"]).cast("double").alias("n"), k.alias("k"),
            squares.alias("squares"), F.aggregate(codes, zero, step).alias("walk"),
        )

    def statistics(c):
        n, k = c["n"], c["k"]
        chi = c["squares"] * k / n - n
        high, low = c["walk"]["high"], n - c["walk"]["high"]
        mean_runs = 2 * high * low / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        # Of uniform codes: variance (k^2 - 1) / 12, and so the product of neighbours.
        spread = (k * k - 1) / 12
        return F.struct(
            c["encoding"].alias("encoding"), n.alias("n"), k.alias("k"), chi.alias("chi"),
            F.when(var_runs > 0, (c["walk"]["runs"] - mean_runs) / F.sqrt(var_runs)).otherwise(F.sqrt(n)).alias("z_runs"),
            (c["walk"]["products"] / (spread * F.sqrt(n - 1))).alias("z_serial"),
            c["walk"]["changes"].alias("changes"),
        )

    def p_values(s):
        n, df = s["n"], s["k"] - 1
        # Exact mean and variance of the statistic for few characters; cube-root scale.
        scale = F.sqrt(1 - 1 / n)
        z_chi = (F.cbrt((s["chi"] - df) / scale / df + 1) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        extra = n * F.greatest(F.lit(0.0), battery.repeat * s["k"] - 1)
        z_word = (s["chi"] - df - extra) / F.sqrt(2 * (df + 2 * extra))
        floor = F.lit(1e-300)
        uneven = F.greatest(floor, _upper_tail(-z_word))
        changes = F.when(s["k"].isin(16.0, 32.0), _at_least(s["changes"], battery.changes * n))
        # Fisher's method over two p-values: four degrees of freedom.
        both = uneven * changes
        p_word = F.when(s["k"] == 16, changes).when(s["k"] == 32, both * (1 - F.log(both))).otherwise(uneven)
        ps = [
            F.greatest(floor, _upper_tail(z_chi)),
            F.greatest(floor, 2 * _upper_tail(F.abs(s["z_runs"]))),
            F.greatest(floor, 2 * _upper_tail(F.abs(s["z_serial"]))),
        ]
        half = -(F.log(ps[0]) + F.log(F.least(F.lit(1.0), ps[1])) + F.log(F.least(F.lit(1.0), ps[2])))
        # Chi-squared with six degrees of freedom has this closed tail.
        fisher = F.exp(-half) * (1 + half + half * half / 2)
        return F.struct(
            s["encoding"].alias("encoding"), n.cast("int").alias("n"), fisher.alias("p_random"),
            F.greatest(floor, p_word).alias("p_word"),
        )

    chain = F.transform(F.array(base), counts)
    return F.transform(F.transform(chain, statistics), p_values)[0]


def _band(t: Column) -> Column:
    """Length band of a test: doubling, two to an octave; some 40 for any length there can
    be. Hex and base32 have bands from 100 and 200."""
    law = F.when(t["encoding"].isin("hex", "hex_upper"), 100).when(t["encoding"] == "base32", 200).otherwise(0)
    return F.floor(2 * F.log2(t["n"])).cast("int") + law


#: p-values are counted in steps of a tenth of a decade, up to this many.
_STEPS = 400


def _step(p: Column) -> Column:
    return F.least(F.lit(_STEPS), F.floor(-10 * F.log10(p)).cast("int"))


def _replaced(text: Column, spans: Column, put) -> Column:
    """The text with ``put(reach, span)`` for each of the sorted spans; ``reach`` is the
    furthest end before it. What overlaps is left out once."""
    wide = F.encode(text, "UTF-32")  # four bytes each: places are offsets

    def step(reach, s):
        gap = F.decode(F.substring(wide, 4 * reach + 1, 4 * (s["start"] - reach)), "UTF-32")
        before = F.when(s["start"] > reach, gap).otherwise(F.lit(""))
        return F.struct(F.greatest(reach, s["end"]).alias("state"), F.array(F.concat(before, put(reach, s))).alias("outs"))

    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    rest = F.decode(F.substring(wide, 4 * last + 1, F.octet_length(wide)), "UTF-32")
    whole = F.concat(F.array_join(scan_array(spans, F.lit(0), step, "string"), ""), rest)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _all_spans(docs: DataFrame, battery: Battery) -> DataFrame:
    """Adds ``base_`` (fixed kinds, sorted) and ``tested_`` (other tokens with p-values).

    Tokens are the runs of each of the two alphabets of base64 in what the base spans leave,
    and the runs of letters and digits inside of them. ``=`` is part of a token as padding only.
    """
    text = F.col("whole_")
    docs = docs.withColumn("whole_", text_or_empty())
    docs = docs.withColumns(
        {"assign_": _spans(text, ASSIGN, 0), "access_": _spans(text, ACCESS, 1), "hex_": _spans(text, HEX, 2)}
    )
    long_enough = F.filter(
        "assign_", lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST
    )
    docs = docs.withColumn("assign_", long_enough)
    docs = docs.withColumn("base_", F.array_sort(F.concat("assign_", "access_", "hex_")))
    # Spaces in place of base spans, so that places stay.
    spaces = _replaced(
        text, F.col("base_"),
        lambda reach, s: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(reach, s["start"]))),
    )
    docs = docs.withColumn("whole_", spaces)
    n = battery.least
    # A run without ``_`` and ``-`` is a run of the other alphabet, or a part of one.
    url = F.filter(_spans(text, f"[A-Za-z0-9_-]{{{n},}}=*", 3), lambda s: s["value"].rlike("[_-]"))
    part = f"(?<=[+/])[A-Za-z0-9]{{{n},}}=*|(?<![A-Za-z0-9])[A-Za-z0-9]{{{n},}}+(?=[+/])"
    docs = docs.withColumn(
        "token_", F.concat(_spans(text, f"[A-Za-z0-9+/]{{{n},}}=*", 3), url, _spans(text, part, 3))
    )
    tested = F.transform(
        "token_", lambda s: F.struct(s.alias("span"), _tests(s["value"], battery).alias("test"))
    )
    docs = docs.withColumn(
        "tested_", F.filter(tested, lambda x: x["test"]["encoding"].isNotNull())
    )
    return docs.drop("assign_", "access_", "hex_", "token_", "whole_")


def _outer(spans: Column) -> Column:
    """Spans that lie in no other, by start."""
    order = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("far"), s.alias("span")))
    )

    def step(reach, x):
        out = F.when(-x["far"] > reach, F.array(x["span"])).otherwise(F.array().cast(f"array<{SPAN}>"))
        return F.struct(F.greatest(reach, -x["far"]).alias("state"), out.alias("outs"))

    return scan_array(order, F.lit(0), step, SPAN)


def thresholds(spans: DataFrame, battery: Battery) -> DataFrame:
    """(band, step): within a length band, tokens at this step or above are discoveries.

    Benjamini-Hochberg over counts by step of p-value: the largest p-value with
    p * tokens <= rate * tokens at or below it. At most bands x steps rows.
    """
    # The outer form: the inner one makes Catalyst put a filter on the array below all the
    # steps that build it, which builds it several times over.
    tokens = spans.select(F.explode_outer("tested_.test").alias("t")).select(
        _band(F.col("t")).alias("band"), _step(F.col("t.p_word")).alias("step")
    )
    counts = tokens.groupBy("band", "step").agg(F.count("band").alias("n")).filter("n > 0")
    by_band = Window.partitionBy("band")
    lower = by_band.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(
        "band", "step", F.sum("n").over(lower).alias("found"), F.sum("n").over(by_band).alias("all")
    )
    return (
        ranked.filter(F.pow(F.lit(10.0), -F.col("step") / 10) * F.col("all") <= battery.rate * F.col("found"))
        .groupBy("band")
        .agg(F.min("step").alias("step"))
    )


def with_spans(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """Adds ``spans_``: array of (start, end, kind, value), sorted by start, then kind.

    Two passes: one counts p-values over the whole corpus and leaves one number for each
    length band (some 120 at most, the only thing the driver sees), the other decides.
    Nothing but those counts is shuffled.
    """
    spans = _all_spans(docs, battery)
    levels = thresholds(_all_spans(docs.select("text"), battery), battery).collect()
    pairs = [x for row in levels for x in (F.lit(row.band), F.lit(row.step))]
    known = F.create_map(*pairs) if pairs else F.create_map().cast("map<int,int>")

    def secret(x):
        t = x["test"]
        passed = F.element_at(known, _band(t))
        return (
            (t["encoding"] != "decimal")
            & (t["p_random"] >= battery.reject)
            & F.coalesce(_step(t["p_word"]) >= passed, F.lit(False))
        )

    found = F.transform(F.filter("tested_", secret), lambda x: x["span"])
    spans = spans.withColumn("found_", found).withColumn("found_", _outer(F.col("found_")))
    return spans.withColumn("spans_", F.array_sort(F.concat("base_", "found_"))).drop("tested_", "found_")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """One row per row of ``docs``: counts, a digest of the base spans, and all spans.

    Spans are code points of the whole text, end exclusive. A null text is empty and has
    none; spans that tie in start come in the order of ``KINDS``; repeated rows give
    repeated results; an empty table gives no rows. Further columns are not looked at.
    """
    rows = with_spans(docs.select("doc_id", "text"), battery)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans_", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return rows.select(
        "doc_id",
        *[count(k) for k in range(3)],
        F.sha2(_joined(F.col("base_")), 256).alias("base_sha256"),
        _joined(F.col("spans_")).alias("spans"),
        count(3),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", battery: Battery = Battery()) -> DataFrame:
    """The documents with every span replaced by ``mark``; columns unchanged.

    Spans that overlap are replaced as one. ``n_chars``, where there is such a
    column, follows the text. Null texts stay null.
    """
    # Packed into a struct, the columns of the documents can have any names.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row_"), "text")
    rows = with_spans(rows, battery)
    whole = _replaced(
        F.col("text").cast("string"), F.col("spans_"),
        lambda reach, s: F.when(s["start"] >= reach, F.lit(mark)).otherwise(F.lit("")),
    )
    has = F.size("spans_") > 0
    rows = rows.select("row_", has.alias("has_"), whole.alias("text_"))
    new = {"text": F.col("text_")}
    if "n_chars" in docs.columns:
        size = F.char_length("text_").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("has_"), size).otherwise(F.col("row_.n_chars"))
    return rows.select(*[new.get(c, F.col(f"row_.`{c}`")).alias(c) for c in docs.columns])
