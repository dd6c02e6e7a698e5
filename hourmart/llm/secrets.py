"""Secret scan (operator 8), DataFrame functions only.

Three patterns (assignments, access keys, long hex runs) and an entropy scan:
over every run of key-like characters a window of fixed length slides; the
counts of its characters are kept per character class (hex, or base64-like),
one in and one out per step, and with them the sum of c*log2(c), from which
the Shannon entropy follows. Windows above the class's threshold merge into a
span. Spans that hold a word of the allow-list, and runs that are a UUID or
lack a digit or a letter, are suppressed; the pattern spans never are.

Positions are code points, end exclusive. They come from the pieces between
matches: ``split`` and ``regexp_extract_all`` cut at the same places.

* null or empty text: no spans. Ties and repeated rows: each row for itself.
* very long texts: entropy costs in proportion to the run, a piece at a time; no rows meet.
* an input column ``secrets`` is replaced; other columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # 16 characters or more
# a run's first match starts where the run does: the lookbehind only spares tries inside it
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KEYLIKE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

#: kinds in the order that breaks ties of the start
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Characters of a run whose windows are counted together.
PIECE = 256
HEX_BITS = 3.0
BASE64_BITS = 3.7
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
HEX_ALPHABET = "0123456789abcdef"
#: runs with one of these in them (any case) are examples or placeholders; UUIDs are identifiers
ALLOW = ("example", "sample", "placeholder", "changeme", "dummy", "xxxxxxxx", "00000000", "deadbeef")
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _no_spans() -> Column:
    return F.array().cast(_SPANS)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, whole, part>> of all leftmost non-overlapping matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,whole:string,part:string>>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        at = s["pos"] + F.char_length(p["gap"])
        return F.struct((at + F.coalesce(F.char_length(p["whole"]), F.lit(0))).alias("pos"),
                        F.when(p["whole"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
                            at.alias("start"), p["whole"].alias("whole"), p["part"].alias("part"))))).alias("out"))

    found = F.aggregate(pairs, start, step, lambda s: s["out"])
    return F.when(text.rlike(pattern), found) \
        .otherwise(F.array().cast("array<struct<start:int,whole:string,part:string>>"))


def _pattern_spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    kept = F.filter(_matches(text, pattern, group), lambda m: F.char_length(m["part"]) >= F.lit(least))
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (m["start"] + F.char_length(m["whole"])).alias("end"))).cast(_SPANS)


def _hot_windows(run: Column, alphabet: str, bits: float, window: int) -> Column:
    """Merged (s, e) of the windows of ``run`` whose character entropy is at least ``bits``.

    A run is cut into pieces of ``PIECE`` characters, each read on to the end of its last window: the counts start
    anew in every piece, so the work follows the run's length.
    """
    def of_piece(pieces: Column, p: Column, j: Column) -> Column:
        further = F.coalesce(F.substring(F.get(pieces, j + F.lit(1)), 1, window - 1), F.lit(""))
        return F.transform(_piece_windows(F.concat(p, further), alphabet, bits, window),
                           lambda w: F.struct((w["s"] + j * F.lit(PIECE)).alias("s"), (w["e"] + j * F.lit(PIECE)).alias("e")))

    def merged(found: Column) -> Column:
        # only spans of neighbouring pieces can touch: a chain's first start and last end are paired off
        firsts = F.filter(found, lambda w, i: (i == F.lit(0)) | (F.get(found, i - F.lit(1))["e"] < w["s"]))
        lasts = F.filter(found, lambda w, i: F.coalesce(F.get(found, i + F.lit(1))["s"] > w["e"], F.lit(True)))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["s"].alias("s"), b["e"].alias("e")))

    pieces = F.regexp_extract_all(run, F.lit(f".{{1,{PIECE}}}"), F.lit(0))
    return bound(lambda ps: bound(merged, F.flatten(F.transform(ps, lambda p, j: of_piece(ps, p, j)))), pieces)


def _piece_windows(run: Column, alphabet: str, bits: float, window: int) -> Column:
    # c * log2(c) by count, and the step's change of it
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    # the characters by number, found once and carried in the state
    codes = F.transform(F.split(run, "", -1), lambda c: F.instr(F.lit(alphabet), c))
    zero = F.struct(codes.alias("codes"), F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("sum"),
                    F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(st: Column, i: Column) -> Column:
        came = F.get(st["codes"], i - F.lit(1))
        left = F.when(i > F.lit(window), F.get(st["codes"], i - F.lit(window + 1))).otherwise(F.lit(0))
        return bound(lambda v: moved(st, i, v["came"], v["left"]), F.struct(came.alias("came"), left.alias("left")))

    def moved(st: Column, i: Column, came: Column, left: Column) -> Column:
        old, gone = F.get(st["n"], came - F.lit(1)), F.get(st["n"], left - F.lit(1))
        change = F.when(came == left, F.lit(0.0)).otherwise(
            F.get(weight, old + F.lit(1)) - F.get(weight, old)
            + F.when(left > F.lit(0), F.get(weight, gone - F.lit(1)) - F.get(weight, gone)).otherwise(F.lit(0.0)))
        counts = F.transform(st["n"], lambda v, j: v + (j + F.lit(1) == came).cast("int")
                             - (j + F.lit(1) == left).cast("int"))
        return bound(lambda total: F.struct(st["codes"].alias("codes"), F.when(came == left, st["n"]).otherwise(counts).alias("n"),
                                            total.alias("sum"), spans(st["out"], i, total).alias("out")), st["sum"] + change)

    def spans(out: Column, i: Column, total: Column) -> Column:
        hot = (i >= F.lit(window)) & (F.lit(math.log2(window)) - total / F.lit(float(window)) >= F.lit(bits))
        last = F.try_element_at(out, F.lit(-1))
        first = i - F.lit(window)
        joins = (F.size(out) > F.lit(0)) & (last["e"] >= first)
        grown = F.concat(F.slice(out, 1, F.size(out) - F.lit(1)),
                         F.array(F.struct(last["s"].alias("s"), i.cast("int").alias("e"))))
        fresh = F.concat(out, F.array(F.struct(first.cast("int").alias("s"), i.cast("int").alias("e"))))
        return F.when(~hot, out).when(joins, grown).otherwise(fresh)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(run)), zero, step, lambda st: st["out"])


def bound(use, value: Column) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entropy_spans(text: Column, window: int, hex_bits: float, base64_bits: float, allow: tuple[str, ...]) -> Column:
    def listed(part: Column) -> Column:
        low = F.lower(part)
        hit = F.lit(False)
        for word in allow:
            hit = hit | low.contains(word)
        return hit

    def kept(run: Column, found: Column) -> Column:
        # a listed word clears the span that it stands in, not the rest of the run
        return F.when(~listed(run), found).otherwise(F.filter(found, lambda w: ~listed(
            F.substring(run, w["s"] + F.lit(1), w["e"] - w["s"]))))

    runs = F.filter(_matches(text, KEYLIKE), lambda m: m["whole"].rlike("[0-9]") & m["whole"].rlike("[A-Za-z]")
                    & ~F.lower(m["whole"]).rlike(UUID))
    none = F.array().cast("array<struct<s:int,e:int>>")
    spans = F.flatten(F.transform(runs, lambda m: F.transform(
        kept(m["whole"], F.when(m["whole"].rlike("^[0-9A-Fa-f]+$"), _hot_windows(F.lower(m["whole"]), HEX_ALPHABET, hex_bits, window))
             .when(F.char_length(m["whole"]) >= F.lit(window),
                   _hot_windows(m["whole"], BASE64_ALPHABET, base64_bits, window)).otherwise(none)),
        lambda w: F.struct((m["start"] + w["s"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
                           (m["start"] + w["e"]).alias("end")))))
    return F.when(text.rlike(KEYLIKE), spans.cast(_SPANS)).otherwise(_no_spans())


def secret_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, hex_bits: float = HEX_BITS,
                 base64_bits: float = BASE64_BITS, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, kind, end), sorted; ``kind`` is an index of ``KINDS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("secrets", F.array_sort(F.concat(
        _pattern_spans(t, "assign", ASSIGN, 2, 8), _pattern_spans(t, "access", ACCESS),
        _pattern_spans(t, "hex", HEX), _entropy_spans(t, window, hex_bits, base64_bits, allow))))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the array's order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < F.lit(KINDS.index("entropy")))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    done = F.aggregate(spans, zero, lambda st, s: F.struct(
        F.greatest(st["pos"], s["end"]).alias("pos"),
        F.when(s["start"] >= st["pos"],
               F.concat(st["out"], F.substring(text, st["pos"] + F.lit(1), s["start"] - st["pos"]), F.lit(mark)))
        .otherwise(st["out"]).alias("out")),
        lambda st: F.concat(st["out"], F.substring(text, st["pos"] + F.lit(1), F.char_length(text))))
    return F.when(F.size(spans) > F.lit(0), done).otherwise(text)
