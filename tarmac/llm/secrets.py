"""Secret scans: fixed patterns, and character Markov models of random strings.

Built-in DataFrame functions only.  Base spans come from three patterns (assignments,
access keys, hex strings; leftmost, non-overlapping per kind).  The strings that they
capture, and the tokens of the same texts outside them, are the labelled samples of
first-order character models: one of random strings, and one of ordinary tokens for each
make-up (``make_up``: without digits, without letters, with digits and letters, with capitals
too).  A token, or what base spans leave of it, becomes a span of its own (kind ``markov``)
when the log-likelihood ratio of the models says that one of its runs of letters and digits is random.

What counts as evidence.  No pair of characters adds more than ``MOST`` nats or takes more than ``AGAINST``, so a run needs
at least THRESHOLD / MOST pairs.  Ordinary tokens are taken to stay within small letters, capitals or
digits unless their samples say otherwise, so numbers inside names are no evidence.  Runs that hold nothing but hex digits
(of one case) are the hex pattern's to judge: shorter ones are numbers, parts of identifiers and dates.
Runs too short to reach the threshold under the fitted models are not scored.

The models are fitted on at most ``SAMPLE`` distinct strings of each label (those with
the smallest hashes); their table has one entry per pair of alphabet characters, and goes into the
plan as one literal array.  Positions are code points, ends exclusive.  All steps over a text's spans are linear in
the text and, but for block sums, in the number of spans.

Defined results: null texts are empty; a table without captured strings gives no markov
spans; rows are independent, so repeated rows and ids give repeated results.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, text_or_empty
from tarmac.operators.sampling import bounded_sample

# Fixed patterns of the base spans: the first group is the keyword, the second the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 or more characters in all
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=.-"
TOKEN = "[A-Za-z0-9+/_=-]"
SAMPLE = 20_000
MAKE_UPS = 4
# Share of a model's characters that is spread over the alphabet, equal in all models.
UNSEEN = 0.01
# How many sightings of a character its own counts must have to weigh as much as the overall ones,
# and as much in one make-up as in all: many, or a lone secret would make itself ordinary.
BACKOFF = 5.0
MAKE_UP_BACKOFF = 1000.0
# Chance that an ordinary token goes on in the class of its last character, before any sample is seen.
STAY = 0.9
CLASSES = (string.ascii_lowercase, string.ascii_uppercase, string.digits)
# Log-likelihood ratio (nats) a run must reach: one secret among a hundred thousand; the most that one pair
# adds to it or takes from it.
THRESHOLD = math.log(1e5)
MOST = 1.7
AGAINST = 0.8
# Runs longer than this can hold any evidence.
LONGEST = 64
# Elements that are summed or appended together, and characters of a text's blocks.
GROUP = 64
BLOCK_CHARS = 256
# Noncharacters of which one that a text lacks stands for its secrets while they are cut out.
FILLERS = [chr(0xFDD0 + k) for k in range(32)]


def _bound(body, **values: Column) -> Column:
    """``body`` of named values, each computed once however often the body uses it."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.get(F.transform(F.array(row), lambda v: body(*[v[k] for k in values])), 0)


def _spans(text: Column, pattern: str, kind: str, accepted: Column | None = None) -> Column:
    """Array of (start, rank, end, kind, value) of the pattern's matches.

    The matched strings and the gaps between them come from one pattern, so their lengths
    add up to positions; sums are taken over groups of ``GROUP`` matches.  ``accepted`` is a
    parallel array of booleans.
    """
    rank = F.lit(KINDS.index(kind))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def add(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + F.length(m["value"])
        span = F.struct(
            start.alias("start"), rank.alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.when(m["good"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def grouped(fields: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(fields) - 1) / GROUP).cast("int"))
        groups = F.transform(numbers, lambda g: F.slice(fields, g * GROUP + 1, F.lit(GROUP)))
        return _bound(placed, groups=groups, sums=F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda acc, m: acc + m["gap"] + F.length(m["value"]))))

    def placed(groups: Column, sums: Column) -> Column:
        def one(group: Column, number: Column) -> Column:
            before = F.aggregate(F.slice(sums, F.lit(1), number), F.lit(0), lambda acc, n: acc + n)
            return F.aggregate(group, F.struct(before.alias("at"), empty.alias("spans")), add, lambda acc: acc["spans"])

        return F.flatten(F.transform(groups, one))

    def fields(matches: Column, good: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), F.length)
        return _bound(grouped, fields=F.arrays_zip(gaps.alias("gap"), matches.alias("value"), good.alias("good")))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    good = F.transform(matches, lambda m: F.lit(True)) if accepted is None else accepted
    return F.when(text.rlike(pattern), _bound(fields, matches=matches, good=good)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All pattern spans by start, then kind."""
    long_enough = F.transform(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE
    )
    return F.array_sort(
        F.concat(_spans(text, ASSIGN, "assign", long_enough), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))
    )


def captured(text: Column) -> Column:
    """The strings that the patterns take for secrets."""
    values = F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE)
    return F.concat(
        F.when(text.rlike(ASSIGN), values).otherwise(F.array().cast("array<string>")),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )


# ------------------------------------------------------------- the models


def filled(text: Column, spans: Column, filler: Column) -> Column:
    """The text with every character of every span overwritten by the filler: positions stay.

    Kind by kind, for spans of one kind do not overlap: the pieces between them are taken from the
    text's blocks and joined once.
    """

    def cut(blocks: Column, own: Column, length: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK_CHARS).cast("int")
            last = F.floor((end - 1) / BLOCK_CHARS).cast("int")
            near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(end > start, F.substring(near, start % BLOCK_CHARS + 1, end - start)).otherwise("")

        def part(s: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(own, i - 1)["end"]).otherwise(0)
            return F.concat(piece(before, s["start"]), F.repeat(filler, s["end"] - s["start"]))

        tail = piece(F.get(own, F.size(own) - 1)["end"], length)
        return F.concat(F.array_join(F.transform(own, part), ""), tail)

    def of_kind(kind: str):
        def step(done: Column, every: Column) -> Column:
            own = F.filter(every, lambda s: s["kind"] == kind)
            blocks = F.regexp_extract_all(done, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
            changed = _bound(cut, blocks=blocks, own=own, length=F.length(done))
            return F.when(F.exists(every, lambda s: s["kind"] == kind), changed).otherwise(done)

        return step

    done = text
    for kind in KINDS:
        done = _bound(of_kind(kind), done=done, every=spans)
    return done


def blanked(text: Column, spans: Column) -> Column:
    """The text with every span overwritten by as many spaces: positions stay."""
    return filled(text, spans, F.lit(" "))


def labelled_samples(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(value, random): at most ``sample`` distinct strings of each label, those with the smallest hashes.

    Strings above a hash cut-off, set by an estimate of how many distinct ones there are, are left out
    before the distinct ones are gathered; it leaves about twice the sample.
    """
    text = text_or_empty(text_col)
    rest = text  # ordinary tokens are looked for outside the secrets
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.when(text.rlike(pattern), F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    strings = {1: captured(text), 0: F.regexp_extract_all(rest, F.lit(TOKEN + "{2,}"), F.lit(0))}
    parts = []
    for label, found in strings.items():
        values = df.select(F.explode(found).alias("value"))
        distinct = values.agg(F.approx_count_distinct("value")).first()[0]
        cut = min(1.0, 2.0 * sample / max(1, distinct))
        few = values.where(F.pmod(F.xxhash64("value"), F.lit(1 << 30)) < int(cut * (1 << 30)))
        parts.append(bounded_sample(checkpointed(few.distinct()), sample, ["value"]).withColumn("random", F.lit(label)))
    return parts[0].unionByName(parts[1])


def make_up(token: Column) -> Column:
    """0: no digit; 1: digits, no letter; 2: digits and small letters; 3: digits and capitals."""
    return (
        F.when(~token.rlike("[0-9]"), 0).when(token.rlike("[A-Z]"), 3).when(token.rlike("[a-z]"), 2).otherwise(1)
    )


def _log_model(counts: dict[str, int], behind: list[float] | None = None, stay: float | None = None) -> list[float]:
    """log P(next | char), row by row; backs off to the characters' frequencies, or to the table ``behind``.

    With ``stay``, frequencies are shared out so that a character of a class is followed by one of
    that class with this chance.
    """
    size = len(ALPHABET)
    seen = [sum(counts.get(a + b, 0) for a in ALPHABET) for b in ALPHABET]
    total = max(1, sum(seen))
    alone = [(1 - UNSEEN) * n / total + UNSEEN / size for n in seen]
    rows, strength = [], BACKOFF if behind is None else MAKE_UP_BACKOFF
    for i, a in enumerate(ALPHABET):
        after = [counts.get(a + b, 0) for b in ALPHABET]
        prior = alone if behind is None else [math.exp(x) for x in behind[i * size : (i + 1) * size]]
        own = next((c for c in CLASSES if a in c), None)
        if stay is not None and own is not None:
            inside = sum(p for b, p in zip(ALPHABET, alone) if b in own)
            prior = [stay * p / inside if b in own else (1 - stay) * p / (1 - inside) for b, p in zip(ALPHABET, alone)]
        rows += [math.log((n + strength * p) / (sum(after) + strength)) for n, p in zip(after, prior)]
    return rows


def fit(samples: DataFrame) -> list[tuple[float, ...]] | None:
    """log P(next | char) under the random model minus under the ordinary one of each make-up, row by row.

    The models back off to their characters' overall frequencies, the ordinary ones within character
    classes; those of a make-up back off to all ordinary tokens.  A symbol that no sample has is as
    likely in all.  None when one of the labels has no sample.
    """
    chars = F.split("value", "")
    pairs = F.zip_with(F.slice(chars, F.lit(1), F.size(chars) - 1), F.slice(chars, F.lit(2), F.size(chars) - 1), lambda a, b: F.concat(a, b))
    counted = (
        samples.select("random", make_up(F.col("value")).alias("kind"), F.explode(F.when(F.size(chars) > 1, pairs).otherwise(F.array().cast("array<string>"))).alias("pair"))
        .groupBy("random", "kind", "pair").agg(F.count(F.lit(1)).alias("n"))
    )
    found = counted.collect()  # bounded by the alphabet
    if {r["random"] for r in found} != {0, 1}:
        return None
    tables: dict = {}
    for r in found:
        for kind in ("all", r["kind"]):
            table = tables.setdefault((r["random"], kind), {})
            table[r["pair"]] = table.get(r["pair"], 0) + r["n"]
    random, ordinary = _log_model(tables[1, "all"]), _log_model(tables[0, "all"], stay=STAY)
    made = [_log_model(tables.get((0, kind), {}), ordinary) for kind in range(MAKE_UPS)]
    return [tuple(max(-AGAINST, min(MOST, r - o)) for o in each) for r, *each in zip(random, *made)]


def _alphabet_of(kind: int) -> list[int]:
    """Places of the characters that a run of a make-up can hold."""
    banned = {0: string.digits, 1: string.ascii_letters, 2: string.ascii_uppercase, 3: ""}[kind]
    return [k for k, c in enumerate(ALPHABET) if c not in banned and c.isalnum()]


def shortest(model: list[tuple[float, ...]], threshold: float) -> list[int | None]:
    """The length below which no run of a make-up can reach the threshold (None: none up to ``LONGEST`` can).

    The most evidence of each length is the heaviest path through the pairs that the make-up can hold.
    """
    size, found = len(ALPHABET), []
    for kind in range(MAKE_UPS):
        places = _alphabet_of(kind)
        best, length = {k: 0.0 for k in places}, 1
        while length < LONGEST and max(best.values()) < threshold:
            best = {b: max(best[a] + model[a * size + b][kind] for a in places) for b in places}
            length += 1
        found.append(length if max(best.values()) >= threshold else None)
    return found


def log_ratio(token: Column, model: list[tuple[float, ...]]) -> Column:
    """Log-likelihood ratio of a run of alphabet characters (random over ordinary) in nats."""
    size = len(ALPHABET)
    numbers = ",".join(repr(entry[kind]) for kind in range(MAKE_UPS) for entry in model)
    table = F.split(F.lit(numbers), ",").cast("array<double>")  # folded into one literal
    first = make_up(token) * size * size
    index = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.size(index) - 1
    steps = F.zip_with(F.slice(index, F.lit(1), n), F.slice(index, F.lit(2), n), lambda a, b: a * size + b)
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + F.get(table, first + x))


# --------------------------------------------------------------- scanning


def scan(df: DataFrame, model: list[tuple[float, ...]] | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``df`` in a struct ``_row``, with ``base`` and ``spans`` (all spans, sorted)."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), text_or_empty(text_col).alias("_text"))
    based = rows.withColumn("base", base_spans(F.col("_text")))
    if model is None:
        return based.withColumn("spans", F.col("base"))
    lengths = shortest(model, threshold)
    if not any(lengths):
        return based.withColumn("spans", F.col("base"))
    # what base spans leave of a token is a token
    free = based.withColumn("_free", F.when(F.size("base") > 0, blanked(F.col("_text"), F.col("base"))).otherwise(F.col("_text")))
    candidate = f"{TOKEN}{{{max(2, min(n for n in lengths if n))},}}"
    random = F.transform(F.regexp_extract_all("_free", F.lit(candidate), F.lit(0)), lambda t: _is_random(t, model, lengths, threshold))
    judged = free.withColumn("_random", random)
    tokens = _spans(F.col("_free"), candidate, "markov", F.col("_random"))
    spans = F.when(F.exists("_random", lambda r: r), F.array_sort(F.concat("base", tokens))).otherwise(F.col("base"))
    return judged.withColumn("spans", spans).drop("_random", "_free")


def _is_random(token: Column, model: list[tuple[float, ...]], lengths: list[int | None], threshold: float) -> Column:
    """Whether a run of the token's letters and digits reaches the threshold."""
    least = F.array(*[F.lit(n or (1 << 30)) for n in lengths])

    def judged(run: Column) -> Column:
        long = F.length(run) >= F.get(least, make_up(run))
        return F.when(long & ~run.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), log_ratio(run, model) >= threshold).otherwise(False)

    return F.exists(F.split(token, "[^A-Za-z0-9]+"), judged)


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping or touching spans replaced by one mark."""

    def marked(clean: Column, filler: Column) -> Column:
        # the filler occurs nowhere else; as a class it needs no quoting
        return F.regexp_replace(filled(clean, spans, filler), F.concat(F.lit("["), filler, F.lit("]+")), F.lit(mark))

    unused = F.get(F.filter(F.array(*[F.lit(c) for c in FILLERS]), lambda c: F.instr(text, c) == 0), 0)
    return F.when(F.size(spans) > 0, _bound(marked, clean=text, filler=F.coalesce(unused, F.lit(FILLERS[0])))).otherwise(text)


def train(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> list[tuple[float, ...]] | None:
    return fit(labelled_samples(df, text_col, sample))


def redact(df: DataFrame, model: list[tuple[float, ...]] | None, text_col: str = "text") -> DataFrame:
    """``df`` with the secrets in ``text_col`` replaced; texts without secrets stay as they are."""
    found = scan(df, model, text_col)
    clean = redacted(F.col("_text"), F.col("spans"))
    return found.select(
        *[
            F.when(F.size("spans") > 0, clean).otherwise(F.col("_row")[c]).alias(c) if c == text_col else F.col("_row")[c].alias(c)
            for c in df.columns
        ]
    )
