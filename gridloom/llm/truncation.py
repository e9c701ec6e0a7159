"""Texts cut off before the author's end.

1. Trailing footers and a cut mark are taken off each text; what remains is its
   body. Footers are learnt: lines whose first word stands (almost) only at the
   end of texts, in many of them, and doesn't begin sentences.
2. Length hazards: per source and way of measuring, the share of texts that end
   at a length among those that reach it. Each hazard is tested against the
   pooled hazard of the neighbouring lengths (Poisson tail of the texts at
   risk), with false-discovery control per source: significant lengths are the
   limits that fields had.
3. Ending statistics of all texts: how often the last words of a body, wherever
   they occur inside a text, end a sentence there. An ending in whose place
   sentences rarely end is incomplete; at a significant length the benefit of
   the doubt is smaller than elsewhere, where only transfers break off.

Whole texts are read and all texts are counted; nothing is sampled. Statistics
are combined per batch before the shuffle, so a source or phrase that a third
of all texts share adds no more rows than any other.

Defined results
---------------
* A null text has no ending and is never found; an empty or blank one neither.
* A body that ends in a sentence mark (also inside closing quotes or brackets)
  is complete unless a cut mark follows it, or white space at a significant length.
* A null source is a source of its own; repeated texts count each time and
  identifiers may be null or repeat.
* An empty table gives no documents. Other columns take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Set
from itertools import compress

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridloom.session import bounded_broadcast, cut_lineage

#: A footer's first word opens lines that are last, or last but one, in this share of its lines and of all texts at least, and ends
#: in a sentence mark in no more than this share. The second bounds the number of footers learnt, whatever the data.
FOOTER_LAST, FOOTER_TEXTS, FOOTER_SENTENCES = 0.8, 1 / 4000, 0.2
#: Marks that a cut leaves; dots alone also end texts that trail off on purpose.
CUT_MARKS = ("[more]", "[truncated]", "[continued]", "[cont]", "[cont.]", "[...]", "[…]", "(more)", "(cont)", "(cont.)", "(continued)", "Read more")
#: Lengths on either side whose hazards a length is compared with, and false-discovery rate.
NEIGHBOURS, FALSE_DISCOVERIES = 20, 0.01
#: Share of a source's lengths whose ends, against what was expected, count as ordinary clustering.
CLUSTERED = 0.95
#: Letters that a cut at a word boundary may fall short of the limit by.
SHORT_BY = 14
#: Occurrences from which a context is trusted.
LEAST_SEEN = 5
#: Shares of sentence ends below which an ending is incomplete: at a significant length, and elsewhere.
INCOMPLETE_AT_LIMIT, INCOMPLETE_ELSEWHERE = 0.6, 0.25
#: Occurrences of longer words from which a rare capitalised ending counts as the start of one of them.
LEAST_LONGER = 20
#: Longest context, in tokens.
CONTEXT = 4
#: Contexts that a batch counts before it passes them on.
FLUSH = 200_000

_TOKEN = re.compile(r"\n+|[^\W\d_]+(?:['’\-][^\W\d_]+)*|\d+(?:[.:,/\-]\d+)*|\.\.\.+|[^\w\s]|_")
_OPEN = re.compile(r"[,;:(\[{&/\-–—�+=<@#$%\\|~]$")


def ends_sentence(text: str) -> bool:
    """Whether a text ends in a sentence mark, perhaps inside quotes, brackets or emphasis."""
    return text.rstrip("'\"”’»)]*_").endswith((".", "!", "?", "。", "！", "？"))


def line_head(line: str) -> str:
    """First word of a line: digits as 0, tags as #, and lines without letters or digits as one."""
    first = line.split(maxsplit=1)[0].lower() if line.strip() else ""
    if first.startswith("#"):
        return "#"
    first = re.sub(r"\d+", "0", first)
    return first if any(c.isalnum() for c in line) or not first else "*"


def body_of(text: str, footers: Set[str] = frozenset()) -> tuple[str, str, str]:
    """(body with its mark, body, mark kind): kind is cut, trail or ''. ``footers`` are heads of lines to take off."""
    rest = text.rstrip()
    while (at := rest.rfind("\n")) >= 0 and line_head(rest[at + 1 :]) in footers:
        rest = rest[:at].rstrip()
    bare = rest
    if bare.endswith(">>"):
        bare = bare.rstrip(">")
    for mark in CUT_MARKS:
        if bare.endswith(mark):
            bare = bare[: -len(mark)]
            break
    if bare != rest:
        bare = bare.rstrip()
        for dots in ("...", "…"):
            bare = bare.removesuffix(dots)
        return rest, bare.rstrip(), "cut"
    bare = rest.rstrip("…") if rest.endswith("…") else rest.rstrip(".") if rest.endswith("...") else rest
    return rest, bare.rstrip(), "trail" if bare != rest and bare.strip() else ""


def learnt_footers(texts: DataFrame) -> frozenset[str]:
    """Heads of the lines that follow texts without belonging to them; at most one per ``FOOTER_TEXTS`` of all texts.

    ``texts`` has one column, ``text``.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines: Counter[str] = Counter()
            last: Counter[str] = Counter()
            stops: Counter[str] = Counter()
            several = 0
            for text in batch["text"]:
                found = [line for line in (text or "").split("\n") if line.strip()]
                heads = [line_head(line) for line in found]
                several += len(heads) > 0
                lines.update(heads)
                tail = set(heads[max(len(heads) - 2, 1) :])
                last.update(tail)
                # the same head may open several trailing lines of a text: counted once on both sides
                lines.subtract({h: heads[max(len(heads) - 2, 1) :].count(h) - 1 for h in tail})
                stops.update({h for h, line in zip(heads, found, strict=True) if ends_sentence(line.rstrip())} & tail)
            rows = [("", several, 0, 0, True)] + [(h, lines[h], last[h], stops[h], False) for h in lines]
            yield pd.DataFrame(rows, columns=["head", "n", "last", "stops", "all"])

    counted = texts.mapInPandas(count, "head string, n long, last long, stops long, all boolean")
    summed = counted.groupBy("head", "all").agg(*[F.sum(c).alias(c) for c in ("n", "last", "stops")])
    often = cut_lineage(summed.where(F.col("all") | (F.col("last") >= FOOTER_LAST * F.col("n"))).where("all OR last >= 5"))
    texts_n = often.where("all").first()
    if texts_n is None:
        return frozenset()
    kept = often.where(~F.col("all") & (F.col("last") >= FOOTER_TEXTS * texts_n["n"]) & (F.col("stops") <= FOOTER_SENTENCES * F.col("last")) & (F.col("head") != ""))
    return frozenset(row["head"] for row in kept.select("head").collect())


def _plain(token: str) -> str:
    """Token of a context: names and numbers by kind, other words in lower case."""
    if token[0].isdigit():
        return "<0>"
    if token[0].isupper():
        return "<W>"
    return "\n" if token[0] == "\n" else token


def hashed_context(kind: str, tail: str) -> int:
    """Signed 64-bit identity of a context."""
    import xxhash

    h = xxhash.xxh64_intdigest(f"{kind}\x1e{tail}".encode("utf-8", "replace"))
    return h - (1 << 64) if h >= 1 << 63 else h


def contexts(tokens: list[str]) -> list[int]:
    """Identities of the last 1 to ``CONTEXT`` tokens."""
    found, tail = [], ""
    for k in range(1, min(CONTEXT, len(tokens)) + 1):
        tail = f"{tokens[-k]}\x1f{tail}"
        found.append(hashed_context(str(k), tail))
    return found


class _Counts:
    """Partial counts per context: seen inside a text, ending a sentence there, closing a body without a sentence mark."""

    def __init__(self) -> None:
        self.seen: Counter[tuple[str, ...]] = Counter()
        self.ended: Counter[tuple[str, ...]] = Counter()
        self.closing: Counter[tuple[str, ...]] = Counter()
        self.capitalised: Counter[str] = Counter()

    def add(self, raw: list[str], plain: list[str]) -> None:
        last = len(raw) - 1
        inside, stops = _positions(raw, plain)
        # contexts of each length end at the same places: shifted lists, zipped, leave out the rest
        for k in range(1, min(CONTEXT, last + 1) + 1):
            shifted = [plain[j : last + 2 - k + j] for j in range(k)]
            self.seen.update(compress(zip(*shifted, strict=True), inside[k - 1 :]))
            self.ended.update(compress(zip(*shifted, strict=True), stops[k - 1 :]))
        if plain[last] not in ".!?" and plain[last][0] != "\n":
            # no sentence mark follows, or the body would not end here
            self.closing.update(tuple(plain[last + 1 - k :]) for k in range(1, min(CONTEXT, last + 1) + 1))
        self.capitalised.update(t for t, p, i in zip(raw, plain, inside, strict=True) if i and p == "<W>")

    def flush(self) -> pd.DataFrame:
        rows = [(contexts(list(key))[-1], self.seen[key], self.ended[key], self.closing[key]) for key in self.seen.keys() | self.closing.keys()]
        # a capitalised word is counted as itself, and as longer than each of its beginnings
        longer: Counter[str] = Counter()
        for word, n in self.capitalised.items():
            rows.append((hashed_context("raw", word), n, 0, 0))
            for i in range(1, len(word)):
                longer[word[:i]] += n
        rows += [(hashed_context("longer", start), n, 0, 0) for start, n in longer.items()]
        for counts in (self.seen, self.ended, self.closing, self.capitalised):
            counts.clear()
        return pd.DataFrame(rows, columns=["context", "seen", "ended", "closing"])


def _positions(raw: list[str], plain: list[str]) -> tuple[list[bool], list[bool]]:
    """Per token whether it stands inside the text (not last, no mark itself), and whether a sentence ends after it."""
    last = len(raw) - 1
    inside = [t not in ".!?" and t[0] != "\n" for t in plain]
    inside[last] = False
    stops = [False] * len(raw)
    for i, after in enumerate(raw[1:]):
        if not inside[i]:
            continue
        following = raw[i + 2] if i + 2 <= last else "\n"
        if after == ".":
            stops[i] = not following[0].islower()
        elif after in "!?…" or after[0] == "\n" or after.startswith("..."):
            stops[i] = True
        elif after in "\"”)":
            stops[i] = i + 2 <= last and following in ".!?"
    return inside, stops


_ENDING = ["doc", "source", "sizes", "mark", "kind", "lower", "contexts"]
_COUNT = ["context", "seen", "ended", "closing"]


def _reader(footers: Set[str]):
    """One pass over the texts: a row per text (lengths by every way of measuring, mark, ending and its contexts), and rows of partial counts."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = _Counts()

        def flushed() -> pd.DataFrame:
            return counts.flush().reindex(columns=[*_ENDING, *_COUNT]).astype(object).where(lambda x: x.notna(), None)

        for batch in batches:
            rows = []
            for doc, source, text in zip(batch["doc"], batch["source"], batch["text"], strict=True):
                if text is None or not text.strip():
                    continue
                marked_body, body, mark = body_of(text, footers)
                raw = _TOKEN.findall(body)
                plain = [_plain(t) for t in raw]
                if raw:
                    counts.add(raw, plain)
                sizes = [len(x) for t in (text, marked_body, body) for x in (t, t.encode("utf-8", "replace"))]
                if mark == "" and ends_sentence(body):
                    # white space left behind a sentence, which a limit leaves as well
                    kind, found = ("spaced" if text[-1].isspace() else "whole"), []
                elif not body or _OPEN.search(body[-1]):
                    kind, found = "open", []
                else:
                    kind = "whole" if ends_sentence(body) else "words"
                    found = contexts(plain[-CONTEXT:])
                    end = raw[-1] if raw else ""
                    if end[:1].isupper():
                        found = [*found, *[0] * (CONTEXT - len(found)), hashed_context("raw", end), hashed_context("longer", end)]
                        # the start of a name that the text spells out elsewhere
                        if end not in raw[:-1] and any(t.startswith(end) for t in raw[:-1]):
                            kind = "open"
                rows.append((doc, source, sizes, mark, kind, body[-1:].islower(), found, None, None, None, None))
            yield pd.DataFrame(rows, columns=[*_ENDING, *_COUNT])
            if len(counts.seen) > FLUSH:
                yield flushed()
        yield flushed()

    return read


def _poisson_tail(observed: pd.Series, expected: pd.Series) -> pd.Series:
    """P(X >= observed) for a Poisson count of the expected size."""

    def tail(k: int, mean: float) -> float:
        if k <= 0:
            return 1.0
        mean = max(mean, 1e-9)
        log_first = -mean + k * math.log(mean) - math.lgamma(k + 1)
        if k <= mean:
            below, term = 0.0, math.exp(-mean)
            for i in range(k):
                below += term
                term *= mean / (i + 1)
            return max(0.0, 1.0 - below)
        total, term, i = 0.0, 1.0, k
        while term > 1e-12 * max(total, 1.0):
            total += term
            i += 1
            term *= mean / i
        return math.exp(log_first + math.log(total))

    return pd.Series([tail(int(k), float(m)) for k, m in zip(observed, expected, strict=True)])


def _at_risk(by: WindowSpec, reach: int) -> Column:
    """Sum of the texts at risk over all lengths within ``reach`` of the row's, also those at which no text ends.

    A row stands for its own length and the gap before it, whose lengths as many
    texts reach as its own; below, the gap of the frame's first row is cut at the
    frame's edge, and above, the next row's reach holds up to the edge.
    """
    near = by.orderBy("length").rangeBetween(-reach, reach)
    beyond = by.orderBy("length").rangeBetween(reach + 1, Window.unboundedFollowing)
    first = F.first(F.struct("length", "gap", "reached")).over(near)
    below = F.greatest(F.col("length") - reach - (first["length"] - first["gap"] + 1), F.lit(0))
    above = F.col("length") + reach - F.max("length").over(near)
    return F.sum(F.col("gap") * F.col("reached")).over(near) - below * first["reached"] + above * F.coalesce(F.first("reached").over(beyond), F.lit(0))


def significant_lengths(lengths: DataFrame) -> DataFrame:
    """(source, measure, length, ended, hazard, p, open_share): limits by false-discovery control, from rows (source, measure, length, open).

    The hazard of a length is the share of the texts that end there among those
    that reach it. Its neighbours' pooled hazard says how many of the texts at
    risk were to end there; at least half a text is taken to end among them.
    ``open_share`` is the share of the texts of this length that lack a sentence mark.
    """
    histogram = lengths.groupBy("source", "measure", "length").agg(
        F.count(F.lit(1)).alias("ended"), F.avg(F.col("open").cast("double")).alias("open_share")
    )
    by = Window.partitionBy("source", "measure")
    upward = by.orderBy("length")
    histogram = histogram.withColumn("reached", F.sum("ended").over(by.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)))
    histogram = histogram.withColumn("gap", F.col("length") - F.coalesce(F.lag("length").over(upward), F.lit(-1)))
    ended = F.sum("ended").over(upward.rangeBetween(-NEIGHBOURS, NEIGHBOURS)) - F.sum("ended").over(upward.rangeBetween(-1, 1))
    pooled = histogram.withColumn("_ended", F.greatest(ended, F.lit(0.5))).withColumn("_at_risk", F.greatest(_at_risk(by, NEIGHBOURS) - _at_risk(by, 1), F.lit(1)))
    # near the greatest length hazards rise by themselves: a limit stands out from the ends per length as well
    by_hazard, by_density = F.col("reached") * F.least(F.col("_ended") / F.col("_at_risk"), F.lit(1.0)), F.col("_ended") / (2 * NEIGHBOURS - 2)
    tested = pooled.withColumn("expected", F.greatest(by_hazard, by_density))
    # texts of one mould or sent twice end together: what all but a few lengths show of that is taken as the size of one event
    together = F.greatest(F.percentile_approx(F.col("ended") / F.greatest(F.col("expected"), F.lit(1.0)), F.lit(CLUSTERED)).over(by), F.lit(1.0))
    tested = tested.withColumns({"_k": F.floor(F.col("ended") / together), "_m": F.col("expected") / together})
    tested = tested.withColumn("p", F.pandas_udf(_poisson_tail, "double")("_k", "_m"))
    number = F.count(F.lit(1)).over(by)
    rank = F.row_number().over(by.orderBy("p", "length"))
    passing = tested.withColumn("_ok", F.col("p") <= FALSE_DISCOVERIES * rank / number)
    limit = F.max(F.when(F.col("_ok"), F.col("p"))).over(by)
    return passing.withColumn("_limit", limit).where(F.col("p") <= F.col("_limit")).select(
        "source", "measure", "length", "ended", (F.col("ended") / F.col("reached")).alias("hazard"), "p", "open_share"
    )


def judged_documents(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc, source, at_limit, mark, kind, share, cut): every text with its ending judged.

    ``share`` is the share of sentence ends at the longest context of the ending
    that was seen often enough, null where none was.
    """
    named = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    id_type = dict(named.dtypes)["doc"]
    footers = learnt_footers(named.select("text"))
    schema = f"doc {id_type}, source string, sizes array<int>, mark string, kind string, lower boolean, contexts array<long>, context long, seen long, ended long, closing long"
    read = cut_lineage(named.mapInPandas(_reader(footers), schema).withColumn("n", F.monotonically_increasing_id()))
    ends = read.where(F.col("kind").isNotNull()).drop(*_COUNT)
    unmarked = (F.col("mark") == "") & (F.col("kind") == "whole")
    measured = ends.select("source", "n", (~unmarked).alias("open"), F.posexplode("sizes").alias("measure", "length"))
    limits = cut_lineage(significant_lengths(measured.drop("n")))

    # candidates at a limit, or short of it by less than a word
    reached = limits.select(
        "source", "measure", F.col("length").alias("limit"), "open_share", F.explode(F.sequence(F.col("length") - SHORT_BY, "length")).alias("length")
    )
    at_limit = (
        measured.where("open")
        .join(bounded_broadcast(reached), ["source", "measure", "length"])
        .groupBy("n")
        .agg(F.max((F.col("length") == F.col("limit")) & (F.col("open_share") >= 0.5)).alias("exact"))
    )

    statistics = read.where(F.col("kind").isNull()).groupBy("context").agg(F.sum("seen").alias("seen"), F.sum("ended").alias("ended"), F.sum("closing").alias("closing"))
    wanted = ends.where(F.size("contexts") > 0).select("n", F.posexplode("contexts").alias("k", "context"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    # few contexts are asked for: their statistics alone are kept, and a common ending asks once
    asked = statistics.join(wanted.select("context").distinct().hint("merge"), "context", "left_semi")
    looked_up = wanted.join(bounded_broadcast(asked), "context", "left").select("n", "k", count("seen").alias("seen"), count("ended").alias("ended"), count("closing").alias("closing"))
    # endings on purpose close text after text: they count as ends, but for the text's own
    others = F.greatest(F.col("closing") - 1, F.lit(0))
    trusted = (F.col("k") < CONTEXT) & ((F.col("seen") >= LEAST_SEEN) | (others >= LEAST_SEEN))
    share = F.when(trusted, (F.col("ended") + others) / (F.col("seen") + others))
    of_k = lambda k, c: F.max(F.when(F.col("k") == k, c))
    judged = looked_up.groupBy("n").agg(
        F.max_by(share, F.when(trusted, F.col("k"))).alias("share"),
        F.max(F.when(trusted, F.col("k") + 1)).alias("trusted_tokens"),
        of_k(0, F.col("seen")).alias("word_seen"),
        of_k(0, others).alias("word_closing"),
        of_k(CONTEXT, F.col("seen")).alias("raw_seen"),
        of_k(CONTEXT + 1, F.col("seen")).alias("longer_seen"),
    )
    joined = ends.drop("sizes", "contexts").join(at_limit.hint("merge"), "n", "left").join(judged.hint("merge"), "n", "left")
    limit, exact = F.col("exact").isNotNull(), count_false(F.col("exact"))
    # closings vouch for a word only where texts trail off on purpose: cut pieces of words close texts as well
    known = count("word_seen") + F.when(F.col("mark") == "trail", count("word_closing")).otherwise(0)
    broken_word = (F.col("lower") & (known < LEAST_SEEN)) | (
        (count("raw_seen") < LEAST_SEEN) & (count("longer_seen") >= LEAST_LONGER)
    )
    known_share = F.coalesce("share", F.lit(0.0))
    doubtful = limit & (count("trusted_tokens") <= 1)  # the word alone says little where a cut is likely
    below = F.when(limit, INCOMPLETE_AT_LIMIT).otherwise(INCOMPLETE_ELSEWHERE)
    words = broken_word | doubtful | (known_share < below) | (exact & ((F.col("mark") == "") | (known_share < 0.95)))
    cut = (F.col("mark") == "cut") | (F.col("kind") == "open") | ((F.col("kind") == "spaced") & exact) | ((F.col("kind") == "words") & words)
    return joined.select("doc", "source", limit.alias("at_limit"), exact.alias("exact_limit"), "mark", "kind", "share", cut.alias("cut"))


def count_false(flag: Column) -> Column:
    """The flag, false where it is null."""
    return F.coalesce(flag, F.lit(False))


def truncation_rates(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(source, documents, truncated, truncation_rate)."""
    judged = judged_documents(docs, doc_id, text, source)
    return judged.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.col("cut").cast("long")).alias("truncated"),
        F.round(F.avg(F.col("cut").cast("double")), 6).alias("truncation_rate"),
    )
