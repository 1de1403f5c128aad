"""Secret scan with column functions only: patterns and sliding-window entropy."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import as_rows

#: Fixed patterns of the base kinds, in the order in which kinds at one place are listed. The
#: keyword letters are spelled in both cases, so that engines with other folding agree.
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
          r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"(AKIA[A-Z0-9]{12,})"
HEX = r"([0-9a-f]{32,})"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_VALUE = 8

#: Entropy windows: characters, and the least bits per character for each class of characters.
WINDOW = 20
CLASSES = (("[0-9a-fA-F]", 3.0), ("[A-Za-z0-9+/_-]", 3.75))
#: Candidates that are no secrets: without a digit or without a letter, placeholders, UUIDs, and
#: words joined by hyphens or underscores or slashes as in names and paths (possessive quantifiers
#: find the same, as neighbouring parts share no character, and need no stack however long the run is).
ALLOWED = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"(?i)example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefgh",
           r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           r"^[A-Za-z]{0,24}+(?:[-_/+]++(?:[A-Za-z]{1,24}+|[0-9]{1,12}+))++[-_/+]*+$")
#: Patterns that a candidate must match as a whole, and words that only count where they stand.
WHOLE = tuple(p for p in ALLOWED if p.startswith("^"))
PLACEHOLDER = "|".join(p for p in ALLOWED if not p.startswith("^"))
#: Characters of a candidate that one fold handles; longer candidates are taken in overlapping pieces.
PIECE = 512
SCALE = 1 << 20
#: Items of an array that one fold gathers.
RUN = 256


def weights(window: int = WINDOW) -> list[int]:
    """c * log2(c) for counts up to the window, as whole numbers, so that sums are exact."""
    return [0] + [round(c * math.log2(c) * SCALE) for c in range(1, window + 2)]


def highest_sum(bits: float, window: int = WINDOW) -> int:
    """The largest sum of c * log2(c) in a window of at least ``bits`` of entropy per character."""
    return math.floor(window * (math.log2(window) - bits) * SCALE)


def matches(text: Column, pattern: str, group: int = 1) -> Column:
    """Array of struct(start, end, text) of the leftmost matches that do not overlap; ``group`` is whole.

    Start and end count code points; the gaps between matches come from splitting at the same pattern.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), group), F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(
        m.alias("text"), F.length(g).cast("bigint").alias("g"), F.length(m).cast("bigint").alias("n")))
    spans = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    zero = F.lit(0).cast("bigint")

    def extend(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        return F.struct((start + x["n"]).alias("at"), F.concat(state["out"], F.array(F.struct(
            start.alias("start"), (start + x["n"]).alias("end"), x["text"].alias("text")))).alias("out"))

    # Places are found inside runs of RUN matches first and then moved by what lies before the run, so
    # that no long array is rebuilt for every match.
    runs = F.transform(_let(pairs, _runs), lambda run: F.aggregate(
        run, F.struct(zero.alias("at"), spans.alias("out")), extend))
    placed = F.aggregate(
        runs, F.struct(zero.alias("at"), F.array(spans).alias("out")),
        lambda state, run: F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["out"], F.array(F.transform(
            run["out"], lambda m: F.struct((state["at"] + m["start"]).alias("start"), (state["at"] + m["end"]).alias("end"),
                                           m["text"].alias("text"))))).alias("out")),
        lambda state: F.flatten(state["out"]))
    return F.when(F.rlike(text, F.lit(pattern)), placed).otherwise(spans)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(items: Column) -> Column:
    """An array cut into arrays of at most RUN items."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(RUN)),
                       lambda at: F.slice(items, at + 1, RUN))


def _times(char: Column, text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, char, F.lit("")))


def entropy_windows(text: Column, least_bits: float, window: int = WINDOW) -> Column:
    """Array of starts of the windows of ``text`` whose Shannon entropy reaches ``least_bits``.

    One pass: the sum of c * log2(c) over the counts in the window is kept, and only the counts of the
    character that leaves and of the one that enters change it.
    """
    table = F.array(*[F.lit(w).cast("bigint") for w in weights(window)])
    limit = highest_sum(least_bits, window)

    def weight(count: Column) -> Column:
        return F.get(table, count)

    def step(state: Column, i: Column) -> Column:
        first = F.greatest(i - window, F.lit(1))
        before = F.substring(text, first, i - first)  # the window that ends before character i
        full = i > window
        gone = F.substring(text, i - window, 1)
        kept = F.when(full, F.substring(text, i - window + 1, window - 1)).otherwise(before)
        here = F.substring(text, i, 1)
        n_gone, n_here = _times(gone, kept), _times(here, kept)
        total = (state["sum"] + F.when(full, weight(n_gone) - weight(n_gone + 1)).otherwise(0)
                 + weight(n_here + 1) - weight(n_here))
        return F.struct(total.alias("sum"), F.when(
            (i >= window) & (total <= limit), F.concat(state["hot"], F.array(i - window)))
            .otherwise(state["hot"]).alias("hot"))

    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<int>").alias("hot"))
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step, lambda s: s["hot"])


def _spans(kind: int, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _running_max(values: Column) -> Column:
    """For each place of an array of bigint the largest value up to there."""
    least, none = F.lit(-1).cast("bigint"), F.array().cast("array<bigint>")

    def extend(state: Column, x: Column) -> Column:
        top = F.greatest(state["top"], x)
        return F.struct(top.alias("top"), F.concat(state["out"], F.array(top)).alias("out"))

    runs = F.transform(_let(values, _runs), lambda run: F.aggregate(
        run, F.struct(least.alias("top"), none.alias("out")), extend))
    return F.aggregate(
        runs, F.struct(least.alias("top"), F.array(none).alias("out")),
        lambda state, run: F.struct(F.greatest(state["top"], run["top"]).alias("top"), F.concat(
            state["out"], F.array(F.transform(run["out"], lambda v: F.greatest(state["top"], v)))).alias("out")),
        lambda state: F.flatten(state["out"]))


def _merged(spans: Column) -> Column:
    """Sorted spans of one kind with those that overlap or touch joined."""
    def join(ordered: Column, tops: Column) -> Column:
        # A joined span starts where no earlier one reaches, and ends at the largest end before the next such start.
        first = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (
            F.get(ordered, i)["start"] > F.get(tops, i - 1)))
        return _let(first, lambda f: F.transform(f, lambda at, n: F.struct(
            F.get(ordered, at)["start"].alias("start"), F.get(ordered, at)["kind"].alias("kind"),
            F.get(tops, F.coalesce(F.get(f, n + 1), F.size(ordered)) - 1).alias("end"))))

    return F.when(F.size(spans) == 0, F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).otherwise(
        _let(F.sort_array(spans), lambda ordered: _let(
            _running_max(F.transform(ordered, lambda x: x["end"])), lambda tops: join(ordered, tops))))


def _entropy(text: Column, base: Column, window: int) -> Column:
    """Spans of high entropy in candidate strings that no allow-list pattern matches as a whole.

    A candidate is cut at base spans and placeholder words, and what is left between them is scanned.
    """
    spans = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    for letters, bits in CLASSES:
        found = matches(text, f"({letters}{{{window},}})")
        allowed = F.filter(found, lambda m: ~F.coalesce(
            _any_like(m["text"]), F.lit(False)))
        allowed = F.flatten(F.transform(allowed, lambda m: _rest(m, base, window)))
        pieces = F.flatten(F.transform(allowed, lambda m: _pieces(m, window)))
        spans = F.concat(spans, F.flatten(F.transform(pieces, lambda p: F.transform(
            entropy_windows(p["text"], bits, window), lambda w: F.struct(
                (p["start"] + w).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
                (p["start"] + w + window).alias("end"))))))
    return _merged(spans)


def _pieces(run: Column, window: int) -> Column:
    """A candidate in pieces of at most PIECE characters that overlap by a window less one."""
    step = PIECE - window + 1
    parts = F.regexp_extract_all(run["text"], F.lit(f"(.{{1,{step}}})"), 1)
    return _let(parts, lambda found: F.transform(found, lambda part, i: F.struct(
        (run["start"] + i * step).alias("start"), F.concat(part, F.coalesce(
            F.substring(F.get(found, i + 1), 1, window - 1), F.lit(""))).alias("text"))))


def _any_like(text: Column) -> Column:
    out = F.lit(False)
    for pattern in WHOLE:
        out = out | F.rlike(text, F.lit(pattern))
    return out


def _rest(run: Column, base: Column, window: int) -> Column:
    """The parts of a candidate, of a window at least, between base spans and placeholder words."""
    def place(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(0).alias("kind"), end.alias("end"))

    words = F.transform(matches(run["text"], f"({PLACEHOLDER})"),
                        lambda w: place(run["start"] + w["start"], run["start"] + w["end"]))
    over = F.transform(
        F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
        lambda b: place(F.greatest(b["start"], run["start"]), F.least(b["end"], run["end"])))
    cuts = _merged(F.concat(words, over))
    starts = F.concat(F.array(run["start"]), cuts["end"])
    ends = F.concat(cuts["start"], F.array(run["end"]))
    parts = F.zip_with(starts, ends, lambda s, e: F.struct(
        s.alias("start"), e.alias("end"),
        F.substring(run["text"], (s - run["start"] + 1).cast("int"), (e - s).cast("int")).alias("text")))
    whole = F.array(F.struct(run["start"].alias("start"), run["end"].alias("end"), run["text"].alias("text")))
    return F.when(F.size(cuts) == 0, whole).otherwise(F.filter(parts, lambda p: F.length(p["text"]) >= window))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """id, base (spans of the patterns) and spans (those and high-entropy strings) of every row.

    A span is struct(start, kind, end): code points from 0, end exclusive, kind a number in ``KINDS``;
    arrays are ordered by start, then kind. Patterns: assignments to a keyword with a value of 8 or
    more characters (a shorter value is passed over, but its match counts as read), access keys,
    long lower-case hex strings; leftmost matches of each kind without overlap. Candidates of the
    entropy scan are runs of one character class of at least ``window`` characters that no
    allow-list pattern matches as a whole; windows at or above the class's entropy that overlap
    neither a base span nor a placeholder word are joined to spans. Null and empty texts have no spans; each row is scanned by itself, so
    repeated rows give equal results; other columns are ignored.
    """
    held = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    text = F.col("t")
    assigned = F.zip_with(matches(text, f"({ASSIGN})"), F.regexp_extract_all(
        text, F.lit(ASSIGN), 2), lambda m, v: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.length(v).alias("n")))
    base = F.sort_array(F.concat(
        _spans(0, F.filter(assigned, lambda m: m["n"] >= ASSIGN_VALUE)),
        _spans(1, matches(text, ACCESS)), _spans(2, matches(text, HEX))))
    first = held.select(id_column, "t", base.alias("base"))
    return first.select(id_column, "base", F.sort_array(F.concat(
        F.col("base"), _entropy(text, F.col("base"), window))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def redact(docs: DataFrame, text_column: str = "text", mark: str = "[SECRET]",
           window: int = WINDOW) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all rows and columns stay, null texts stay null.

    Spans of any kind that overlap or touch are replaced by one mark.
    """
    named = as_rows(docs, text=F.col(text_column))
    spans = find_secrets(named, "_row", "text", window).withColumn("spans", _merged(F.col("spans")))
    text = F.col("_row")[text_column]

    def cut(source: Column, start: Column, end: Column) -> Column:
        return F.substring(source, (start + 1).cast("int"), (end - start).cast("int"))

    def marked(run: Column) -> Column:
        """A run of spans, with the text before each, from a substring that holds only them."""
        base = run[0]["from"]
        near = F.array(cut(text, base, F.element_at(run, -1)["to"]))
        return F.array_join(F.flatten(F.transform(near, lambda part: F.transform(run, lambda x: F.concat(
            cut(part, x["from"] - base, x["to"] - base), F.lit(mark))))), "")

    gaps = F.transform("spans", lambda x, i: F.struct(
        F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(F.col("spans"), i - 1)["end"]).alias("from"),
        x["start"].alias("to")))
    tail = cut(text, F.element_at("spans", -1)["end"], F.length(text).cast("bigint"))
    pieces = F.concat(F.array_join(F.transform(_let(gaps, _runs), marked), ""), tail)
    clean = F.when(F.size("spans") > 0, pieces).otherwise(text)
    return spans.select(F.col("_row").withField(f"`{text_column}`", clean).alias("_row")).select("_row.*")
