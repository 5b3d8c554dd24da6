"""Secret scans: fixed patterns, and character Markov models for strings of no known form.

Two first-order Markov models of characters are trained, one on secrets that the fixed patterns
find and one on the ordinary words and identifiers around them. A long token is a secret when
the first explains it clearly better: by the log-likelihood ratio, in all and per character.
All of it is column expressions; there is no Python in any task.

The spans of the fixed patterns are cut out of a text first; tokens are looked for in what is
left between them, so that a secret next to a fixed span is found as well. A token has `LEAST`
characters or more: shorter random strings are not scored. Spans carry byte offsets beside
positions, as a cut by bytes does not walk the text, and lists are put together in blocks, so
that the work is in proportion to the text however many spans it has.

Defined results: a null text counts as empty and has no spans. Repeated rows are scanned each.
Without labelled samples of one sort that model is uniform; without ordinary words nothing but
the fixed patterns is found. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The patterns, the group whose length counts, and its least length.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the same as runs of one or more of which those below 32 are dropped
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
MARKOV = "markov"

# What a token of unknown form is made of, and its least length.
LEAST = 20
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{2,}"
LOWEST, CODES = ord("+"), ord("z") - ord("+") + 1
LEAST_DISTINCT = 8

# Documents that the models are trained on: those first by a hash of their id.
MAX_SAMPLE = 5_000

SPAN = "struct<start:int,kind:int,end:int,token:string>"
WIDE = "struct<start:int,kind:int,end:int,token:string,first:int,last:int>"
PIECE = "struct<start:int,first:int,text:string>"
KINDS = [k for k, *_ in BASE] + [MARKOV]

# A list grows by copies of itself: so many elements are put together before they join the rest.
BLOCK = 512


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _fold(items: Column, kind: str, step, last=None) -> Column:
    """The elements that step(at, byte, item) gives for each item, in order.

    `step` returns (at, byte, new elements); at and byte begin at 0 and go from item to item.
    `last` gives the elements after the last item.
    """

    def state(at: Column, byte: Column, found: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), byte.cast("int").alias("byte"), found.alias("found"))

    def one(s: Column, item: Column) -> Column:
        at, byte, new = step(s["at"], s["byte"], item)
        return state(at, byte, F.concat(s["found"], new.cast(f"array<{kind}>")))

    def folded(all_items: Column) -> Column:
        def block(s: Column, b: Column) -> Column:
            return F.aggregate(
                F.slice(all_items, b * BLOCK + 1, F.lit(BLOCK)),
                state(s["at"], s["byte"], _none(kind)),
                one,
                lambda t: state(t["at"], t["byte"], F.concat(s["found"], F.array(t["found"]))),
            )

        def finish(s: Column) -> Column:
            found = F.flatten(s["found"])
            return found if last is None else F.concat(found, last(s["at"], s["byte"]).cast(f"array<{kind}>"))

        blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_items) - 1, F.lit(0)) / BLOCK).cast("int"))
        begin = state(F.lit(0), F.lit(0), F.array().cast(f"array<array<{kind}>>"))
        return F.aggregate(blocks, begin, block, finish)

    return _let(items, folded)


def _matches(text: Column, kind: int, pattern: str, group: int = 0, least: int = 1) -> Column:
    """Spans of a pattern's leftmost matches without overlap, in order.

    The text between matches, by split, and the matches themselves give the positions.
    """
    between = F.split(text, pattern, -1)
    parts = _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda whole: F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("between"), whole.alias("whole")),
    )

    def step(at: Column, byte: Column, part: Column):
        whole = part["whole"]
        start, first = at + F.char_length(part["between"]), byte + F.octet_length(part["between"])
        end, last = start + F.char_length(whole), first + F.octet_length(whole)
        span = F.array(F.struct(start, F.lit(kind), end, whole, first, last)).cast(f"array<{WIDE}>")
        counted = F.regexp_extract(whole, pattern, group) if group else whole
        return end, last, F.when(F.char_length(counted) >= least, span).otherwise(_none(WIDE))

    return F.when(text.rlike(pattern), _fold(parts, WIDE, step)).otherwise(_none(WIDE))


def _slim(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"], s["token"])).cast(f"array<{SPAN}>")


def _base(text: Column) -> dict[str, Column]:
    return {k: _matches(text, n, p, g, least) for n, (k, p, g, least) in enumerate(BASE)}


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each fixed pattern."""
    return {k: _slim(v) for k, v in _base(text).items()}


def _outside(text: Column, spans: Column) -> Column:
    """What is left of a text between spans, as (start, first byte, text)."""

    def pieces(raw: Column) -> Column:
        def piece(at: Column, byte: Column, to: Column) -> Column:
            cut = F.substring(raw, byte + 1, F.greatest(to - byte, F.lit(0))).cast("string")
            found = F.array(F.struct(at, byte, cut)).cast(f"array<{PIECE}>")
            return F.when(to > byte, found).otherwise(_none(PIECE))

        def step(at: Column, byte: Column, span: Column):
            new = piece(at, byte, span["first"])
            return F.greatest(at, span["end"]), F.greatest(byte, span["last"]), new

        return _fold(F.sort_array(spans), PIECE, step, lambda at, byte: piece(at, byte, F.octet_length(raw)))

    return _let(text.cast("binary"), pieces)  # once: a cast copies the text


def _tokens(pieces: Column) -> Column:
    """Spans of long tokens in pieces of a text."""

    def placed(piece: Column) -> Column:
        return F.transform(
            _matches(piece["text"], len(BASE), TOKEN),
            lambda t: F.struct(
                t["start"] + piece["start"], t["kind"], t["end"] + piece["start"], t["token"],
                t["first"] + piece["first"], t["last"] + piece["first"],
            ).cast(WIDE),
        )

    long = F.filter(pieces, lambda p: p["text"].rlike(TOKEN))
    return F.flatten(F.transform(long, placed))


def _codes(token: Column) -> Column:
    """A token's characters as places in the alphabet."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c) - LOWEST)


@dataclass(frozen=True)
class Model:
    """log P(next | last) of the random model less that of the ordinary one, CODES x CODES."""

    ratios: tuple[float, ...]
    least_total: float = 12.0
    least_mean: float = 0.6

    def column(self) -> Column:
        """The ratios as one literal array; the optimizer folds it once per plan."""
        return F.split(F.lit(",".join(repr(round(x, 6)) for x in self.ratios)), ",").cast("array<double>")

    def is_secret(self, codes: Column) -> Column:
        ratios = self.column()
        steps = F.sequence(F.lit(1), F.size(codes) - 1)
        total = F.aggregate(
            steps,
            F.lit(0.0),
            lambda acc, i: acc + F.get(ratios, F.get(codes, i - 1) * CODES + F.get(codes, i)),
        )
        enough = F.greatest(F.lit(self.least_total), F.lit(self.least_mean) * (F.size(codes) - 1))
        return (F.size(F.array_distinct(codes)) >= LEAST_DISTINCT) & (total >= enough)


def _transitions(counts: dict[str, float], spread: float, weight: float) -> list[list[float]]:
    """P(next | last): counts with `spread` added to each, mixed with the uniform model."""
    table = [[spread] * CODES for _ in range(CODES)]
    for pair, n in counts.items():
        table[ord(pair[0]) - LOWEST][ord(pair[1]) - LOWEST] += n
    return [[weight * x / sum(row) + (1 - weight) / CODES for x in row] for row in table]


def train(random: dict[str, float], ordinary: dict[str, float], **options) -> Model:
    """The model of two tables of counts of neighbouring characters.

    The random model is mixed half and half with the uniform one, as there is no telling which
    characters a secret of unknown form is made of.
    """
    a = _transitions(random, 1.0, 0.5)
    b = _transitions(ordinary, 0.2, 1.0) if ordinary else a
    return Model(tuple(math.log(x / y) for r, s in zip(a, b) for x, y in zip(r, s)), **options)


def fit(
    docs: DataFrame, id: str = "doc_id", text: str = "text", max_sample: int = MAX_SAMPLE, **options
) -> Model:
    """Train on a bounded sample of documents: what the fixed patterns find is labelled random,
    the words outside of it ordinary."""
    chosen = (
        docs.select(F.col(id).alias("_id"))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_sample)
    )
    sample = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(
        F.broadcast(chosen), "_id"  # at most max_sample ids
    )
    outside = F.col("_text")
    secrets = F.array().cast("array<string>")
    for _, pattern, group, _ in BASE:
        outside = F.regexp_replace(outside, pattern, " ")
        found = F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))
        secrets = F.concat(secrets, F.when(F.col("_text").rlike(pattern), found).otherwise(F.array().cast("array<string>")))
    words = F.regexp_extract_all(outside, F.lit(ORDINARY), F.lit(0))
    random = sample.select(F.lit(True).alias("random"), F.explode(secrets).alias("token"))
    # Dots may be in a value that is assigned, but are not in the models' alphabet.
    random = random.select("random", F.explode(F.split("token", r"[^A-Za-z0-9+/_=-]")).alias("token"))
    ordinary = sample.select(F.lit(False).alias("random"), F.explode(words).alias("token"))
    tokens = random.union(ordinary).where(F.length("token") > 1).groupBy("random", "token").count()
    pairs = (
        tokens.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("token") - 1)))
        .select("random", F.substring(F.col("token"), F.col("i"), F.lit(2)).alias("pair"), "count")
        .groupBy("random", "pair")
        .agg(F.sum("count").alias("n"))
        .collect()  # CODES x CODES pairs at most, twice
    )
    counts = {flag: {r["pair"]: r["n"] for r in pairs if r["random"] == flag} for flag in (True, False)}
    return train(counts[True], counts[False], **options)


def _found(whole: Column, model: Model) -> Column:
    """A struct of arrays of wide spans, one for each kind; no part is computed twice."""

    def secret(base: Column) -> Column:
        known = F.concat(*[base[k] for k, *_ in BASE])
        coded = F.transform(
            _tokens(F.when(whole.rlike(TOKEN), _outside(whole, known)).otherwise(_none(PIECE))),
            lambda t: F.struct(t.alias("span"), _codes(t["token"]).alias("codes")),
        )
        markov = F.transform(F.filter(coded, lambda t: model.is_secret(t["codes"])), lambda t: t["span"])
        return F.struct(*[base[k].alias(k) for k, *_ in BASE], markov.alias(MARKOV))

    return _let(F.struct(*[v.alias(k) for k, v in _base(whole).items()]), secret)


def scanned(docs: DataFrame, model: Model, text: str = "text", to: str = "secrets") -> DataFrame:
    """docs with a struct `to` of arrays of spans: assign, access, hex and markov.

    A column of the name `to` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    slim = _let(_found(whole, model), lambda f: F.struct(*[_slim(f[k]).alias(k) for k in KINDS]))
    return docs.withColumn(to, slim)


def span_list(spans: Column) -> Column:
    """`kind:start:end` of each span by start, then kind as listed, joined with commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(
        F.sort_array(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def redacted(docs: DataFrame, model: Model, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret in the text replaced by mark; texts without one stay as they are."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def clean(spans: Column, raw: Column) -> Column:
        def cut(byte: Column, length: Column) -> Column:
            return F.array(F.substring(raw, byte + 1, length).cast("string"))

        def step(at: Column, byte: Column, span: Column):
            # A span that begins inside the one before only lengthens it.
            new = F.concat(cut(byte, span["first"] - byte), F.array(F.lit(mark)))
            fresh = F.when(span["first"] >= byte, new).otherwise(_none("string"))
            return at, F.greatest(byte, span["last"]), fresh

        parts = _fold(spans, "string", step, lambda at, byte: cut(byte, F.octet_length(raw) - byte))
        return F.array_join(parts, "")

    def replaced(spans: Column) -> Column:
        some = _let(whole.cast("binary"), lambda raw: clean(spans, raw))
        return F.when(F.size(spans) > 0, some).otherwise(F.col(text))

    spans = _let(_found(whole, model), lambda f: F.sort_array(F.concat(*[f[k] for k in KINDS])))
    return docs.withColumn(text, _let(spans, replaced))
