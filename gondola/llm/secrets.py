"""Secret scan: fixed patterns, plus sliding-window entropy of candidate strings.

Candidates are maximal runs of ``[A-Za-z0-9+/_=-]`` of the shortest window's length at least. Placeholders (fixed
words and sequences) cut a run into pieces; a piece's character class (hex, letters in both cases, alphanumeric,
base64) fixes window and threshold. The entropy of a window with counts c is ``log2(w) - sum(c * log2(c)) / w``. The
counts of the window are carried along: when it moves by one character, the count of the one that leaves and
of the one that enters change, and with them the sum. A candidate is a secret if the best window of some piece
reaches the threshold and no allow-list form (numbers, UUIDs, slugs of plain words and numbers) fits the
piece or the whole run.

Regular expressions have no positions in Spark, so they are added up from the texts between matches
(``split``) and the matches themselves, in chunks of ``CHUNK`` matches: work grows with the text, not with the
square of the matches in it.

Edge cases: null and empty texts have no spans; repeated rows are scanned each; an empty table
gives no rows; columns of ``docs`` other than doc_id and text are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
# Character class: pattern of a whole piece, window, entropy threshold in bits.
CLASSES = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 24, 3.0),
    ("letters", r"^[A-Za-z]+$", 20, 4.0),
    ("alnum", r"^[A-Za-z0-9]+$", 20, 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 20, 3.7),
)
PLACEHOLDER = r"(?i)example|placeholder|changeme|x{4,}|0123456789|abcdefgh"
CHUNK = 128


def _allowed(value: Column) -> Column:
    """Numbers, UUIDs, slugs of plain words and numbers, letters of one case."""
    numbers = ~value.rlike("[A-Za-z]")
    uuid = value.rlike(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
    slug = ~value.rlike(r"[A-Za-z][0-9]|[0-9][A-Za-z]|[+=]") & value.rlike("[-_/]")
    one_case = ~value.rlike("[0-9]") & (~value.rlike("[A-Z]") | ~value.rlike("[a-z]"))
    # Words joined by capitals are no keys: a key changes from small to capital far more often.
    joined = value.rlike("^[A-Za-z]+$") & (8 * F.size(F.split(value, "(?<=[a-z])(?=[A-Z])")) < F.length(value))
    return numbers | uuid | slug | one_case | joined


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(items: Column) -> Column:
    """An array cut into arrays of CHUNK elements."""

    def cut(x: Column) -> Column:
        last = F.ceil(F.size(x) / CHUNK).cast("int") - 1
        parts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(x, k * CHUNK + 1, CHUNK))
        return F.when(F.size(x) > 0, parts).otherwise(F.slice(parts, 1, 0))

    return _let(items, cut)


def _running(values: Column, start: Column, step) -> Column:
    """The state before each element, from ``start``, and the one after the last. For short arrays."""

    def add(state: Column, x: Column) -> Column:
        return F.concat(state, F.array(step(F.element_at(state, -1), x)))

    return F.aggregate(values, F.array(start), add)


def _located(text: Column, pattern: str, kind: str) -> Column:
    """Matches of a pattern, as an array of (kind, start, end, value)."""
    empty = F.lit(None).cast("array<struct<kind:int,start:int,end:int,value:string>>")
    none = F.coalesce(empty, F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>"))
    between = F.split(text, pattern, -1)

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        found = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            pair["value"].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    def length(total: Column, pair: Column) -> Column:
        return total + F.length(pair["gap"]) + F.length(pair["value"])

    def one(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), none.alias("found")), add, lambda s: s["found"])

    def places(matches: Column) -> Column:
        pairs = F.zip_with(
            F.slice(between, 1, F.size(matches)),
            matches,
            lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
        )

        def found(chunks: Column) -> Column:
            ends = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), length))
            starts = F.slice(_running(ends, F.lit(0), lambda a, b: a + b), F.lit(1), F.size(chunks))
            return F.flatten(F.zip_with(chunks, starts, one))

        return _let(_chunks(pairs), found)

    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)).otherwise(none)


def _weight(count: Column) -> Column:
    """c * log2(c), 0 for no occurrence."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)


def window_entropy(value: Column, window: Column | int) -> Column:
    """The largest Shannon entropy (bits) of any window of a string of ASCII characters from ``+`` to ``z``; 0 if
    it is shorter. The counts are a string with a place for each character: letter A is 0, B is 1 and so on."""
    window = F.lit(window) if isinstance(window, int) else window
    places = F.transform(F.slice(F.split(value, ""), F.lit(1), F.length(value)), lambda c: F.ascii(c) - (ord("+") - 1))

    def with_leaving(places: Column) -> Column:
        """Each character that enters and the one that leaves with it; 0 while the window fills."""
        kept = F.slice(places, F.lit(1), F.greatest(F.size(places) - window, F.lit(0)))
        leaving = F.concat(F.array_repeat(F.lit(0), window), kept)
        return F.zip_with(places, leaving, lambda a, b: F.struct(a.alias("enters"), b.alias("leaves")))

    moves = F.filter(_let(places, with_leaving), lambda m: m["enters"].isNotNull())
    count = lambda counts, at: F.ascii(F.substring(counts, at, F.lit(1))) - ord("A")
    put = lambda counts, at, n: F.overlay(counts, F.char(n + ord("A")), at, F.lit(1))

    def slide(state: Column, move: Column) -> Column:
        enters, leaves = move["enters"], move["leaves"]
        out = count(state["counts"], leaves)
        fewer = F.when(leaves > 0, put(state["counts"], leaves, out - 1)).otherwise(state["counts"])
        less = F.when(leaves > 0, state["sum"] - _weight(out) + _weight(out - 1)).otherwise(state["sum"])
        into = count(state["counts"], enters)  # leaves is another character
        moved = F.struct(
            put(fewer, enters, into + 1).alias("counts"),
            (less + _weight(into + 1) - _weight(into)).alias("sum"),
            F.when(leaves > 0, F.least(state["least"], state["sum"])).otherwise(state["least"]).alias("least"),
        )
        return F.when(leaves == enters, state).otherwise(moved)

    none = F.struct(F.lit("A" * 80).alias("counts"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))
    # ``least`` holds the windows before the last move; the last one is in ``sum``.
    least = F.aggregate(moves, none, slide, lambda s: F.least(s["least"], s["sum"]))
    return F.when(F.length(value) >= window, F.log2(window.cast("double")) - least / window).otherwise(0.0)


def _is_secret(value: Column) -> Column:
    def piece_is_secret(piece: Column) -> Column:
        window, threshold = F.lit(None).cast("int"), F.lit(None).cast("double")
        for _, pattern, w, least in reversed(CLASSES):
            window = F.when(piece.rlike(pattern), w).otherwise(window)
            threshold = F.when(piece.rlike(pattern), least).otherwise(threshold)
        shortest = min(w for _, _, w, _ in CLASSES)
        return F.when((F.length(piece) < shortest) | _allowed(piece), F.lit(False)).otherwise(
            F.coalesce(window_entropy(piece, window) >= threshold, F.lit(False))
        )

    return F.when(_allowed(value), F.lit(False)).otherwise(F.exists(F.split(value, PLACEHOLDER, -1), piece_is_secret))


def found_spans(text: Column) -> Column:
    """All spans of a text by start, then kind: array of (kind, start, end, value)."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(
        _located(text, ASSIGN, "assign"),
        lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= ASSIGN_LEAST,
    )
    entropy = F.filter(_located(text, CANDIDATE, "entropy"), lambda m: _is_secret(m["value"]))
    spans = F.concat(assign, _located(text, ACCESS, "access"), _located(text, HEX, "hex"), entropy)
    order = lambda m: F.struct(m["start"], m["kind"], m["end"], m["value"])
    return F.transform(
        F.array_sort(F.transform(spans, order)),
        lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")),
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind as an index into KINDS, start, end, value) of every row."""
    return docs.select("doc_id", found_spans(F.col("text")).alias("spans"))


def written_out(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda m: F.concat_ws(
        ":", F.element_at(names, m["kind"] + 1), m["start"].cast("string"), m["end"].cast("string")
    )
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """docs with every found span, overlapping ones as one, replaced in ``text`` (and ``n_chars`` kept true)."""
    spans, text = F.col("spans__"), F.col("text")

    def one(chunk: Column, at: Column) -> Column:
        """The text from ``at`` to the chunk's last end, masked; substrings are taken from this part only."""
        part = text.substr(at + 1, F.greatest(F.array_max(F.transform(chunk, lambda m: m["end"])) - at, F.lit(0)))

        def cut(state: Column, m: Column) -> Column:
            gap = state["part"].substr(state["at"] - at + 1, F.greatest(m["start"] - state["at"], F.lit(0)))
            fresh = m["start"] >= state["at"]
            out = F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"])
            return F.struct(state["part"].alias("part"), F.greatest(state["at"], m["end"]).alias("at"), out.alias("out"))

        start = F.struct(part.alias("part"), at.alias("at"), F.lit("").alias("out"))
        return F.aggregate(chunk, start, cut, lambda s: s["out"])

    def masked(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda m: m["end"])))

        def joined(at: Column) -> Column:
            parts = F.zip_with(chunks, F.slice(at, F.lit(1), F.size(chunks)), one)
            return F.concat(F.array_join(parts, ""), text.substr(F.element_at(at, -1) + 1, F.length(text)))

        return _let(_running(ends, F.lit(0), F.greatest), joined)

    clean = F.when(F.size(spans) > 0, _let(_chunks(spans), masked)).otherwise(text)
    out = docs.withColumn("spans__", found_spans(text)).withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans__") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
