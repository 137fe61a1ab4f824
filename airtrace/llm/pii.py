"""Personal data by weak supervision (DataFrame and SQL functions only).

Four kinds of spans are looked for: ``email``, ``ip``, ``card``, ``phone``.

1. *Base spans.*  Each kind has a base pattern, matched leftmost and without
   overlaps, and a check of the match (parts up to 255, the Luhn sum, a
   number of digits).  Matches that pass are spans, whatever follows.
2. *Candidates* are all matches of the base patterns, also failing ones, and
   of a wider pattern a kind (spelt-out addresses, one of several numbers in
   a row, national phone numbers).
3. *Labelers* vote on each candidate, for (1), against (-1) or not at all
   (0): regular expressions for the strict form, gazetteers of endings,
   issuers and dialling codes, cue words of the context, the edges, the
   check.  No labeler is trusted beforehand.
4. *Aggregation.*  Expectation-maximisation on the counts of the vote
   patterns estimates, for each kind, how often true and false candidates
   get each vote of each labeler, and with that the probability that a
   candidate is true.
5. *Span classifier.*  A naive Bayes classifier over the candidate's own
   features (shape, neighbours, words before it, check) learns from these
   probabilities, not from votes.  Candidates that it holds for likely
   enough and that touch no base span are added.

A text is scanned once.  Match positions are sums of the lengths of matches
and of the gaps between them; they are taken over the exploded matches, so a
text with many matches costs in proportion.  Matches, with at most
``CONTEXT`` characters of the gaps around them, are shuffled once, by their
row; no text is.  The vote patterns (at most 3**labelers a kind) and the
classifier's weights (``SLOTS`` a kind) have sizes that do not grow with the
data; only the labelers' reliabilities come to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtrace.llm.common import whole_text, write_through

KINDS = ("email", "ip", "card", "phone")
#: A candidate is added from this probability on.
ADD_AT = 0.9
CONTEXT = 40
SLOTS = 4096
#: Steps of expectation-maximisation at most, and the change that ends them.
STEPS = 15
SETTLED = 1e-3
#: Pull of a feature's weight to 0, as a number of candidates.
_SHRINK = 10.0

# --- fixed values -----------------------------------------------------------
# Base patterns.  Runs are possessive and begin where a run begins (or where
# the last match ended), which finds the same matches in linear time.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)"
             r"[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:(?:[\x20-]?[0-9]{4}){3}|[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?[0-9(][0-9)]{0,5}+(?:[\x20-]\(?[0-9]{2,5}\)?){2,5}(?![0-9A-Za-z])",
}
# Forms that a labeler holds for proper.
_STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}$",
    "phone": r"^(?:\+|00)[1-9][0-9]{0,2}[ .-]?\(?[0-9]{1,5}\)?(?:[ .-]?[0-9]{2,5}){1,5}$",
}
# Gazetteers: last labels of host names; networks of hosts; issuer and dialling codes.
_KNOWN = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|mil|int|info|biz|io|dev|app|[a-z]{2})$",
    "ip": r"^(?!0|127\.|169\.254\.|2[4-9][0-9]|22[4-9]|23[0-9])[0-9]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^(?:\+|00)(?:1|7|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
             r"|2[1-69][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[058][0-9]|9[679][0-9])",
}
# Words before a span that speak for its kind, and words that speak against all.
_CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|courriel|correo|kontakt|schreib\w*|escrib\w*)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client|login|adresse|serveur|servidor|rechner)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|pay\w*)\b",
    "phone": r"(?i)\b(?:tel|phone|call|mobile|cell|fax|dial|telefon|handy|t[ée]l[ée]phone|tel[ée]fono|ll[aá]m\w*)\b",
}
_COUNTER_CUES = (
    r"(?i)\b(?:order|invoice|isbn|issn|version|build|release|section|chapter|figure|table|page|ref|sku|serial"
    r"|id|nr|no|commande|facture|bestellung|rechnung|pedido|factura|kapitel|chapitre)\b"
)
# ---------------------------------------------------------------------------

LABELERS = ("check", "strict", "gazetteer", "cue", "counter_cue", "edges", "base", "digits")


def _of_kind(values: dict[str, str], make) -> Column:
    """``make(value)`` of the row's kind."""
    out = None
    for k, kind in enumerate(KINDS):
        this = F.col("kind") == k
        out = F.when(this, make(values[kind])) if out is None else out.when(this, make(values[kind]))
    return out


def _vote(condition: Column, yes: int, no: int) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every match of every pattern, and a row for each document.

    ``row`` numbers the rows of ``docs``; ``_id``; ``kind`` is the place in
    ``KINDS``, -1 for the row of the document itself; ``wide``; ``pos`` counts
    a pattern's matches; ``gap`` is the length of the text between the match
    before and this one, ``tail`` and ``head`` its last and first characters;
    ``hit`` is the match, null after the last one.
    """
    text = F.col("_text")
    searches = [F.struct(F.lit(-1).alias("kind"), F.lit(False).alias("wide"), F.lit("").alias("pattern"),
                         F.array(F.lit("")).alias("hits"))]
    for k, kind in enumerate(KINDS):
        for wide, patterns in ((False, _BASE), (True, _WIDE)):
            found = F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))
            searches.append(F.struct(F.lit(k).alias("kind"), F.lit(wide).alias("wide"),
                                     F.lit(patterns[kind]).alias("pattern"), found.alias("hits")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("_id"),
                       whole_text(text_col).alias("_text"))
    found = rows.select("row", "_id", "_text", F.explode(F.array(*searches)).alias("s")).where(
        F.size("s.hits") > 0)
    gaps = F.when(F.col("s.kind") < 0, F.array(F.lit(""))).otherwise(F.split(text, F.col("s.pattern"), -1))
    parts = found.select("row", "_id", F.col("s.kind").alias("kind"), F.col("s.wide").alias("wide"),
                         F.posexplode(F.arrays_zip(gaps.alias("gap"), F.col("s.hits").alias("hit"))))
    return write_through(
        parts.select(
            "row", "_id", "kind", "wide", "pos", F.length("col.gap").alias("gap"),
            F.right("col.gap", F.lit(CONTEXT)).alias("tail"), F.left("col.gap", F.lit(1)).alias("head"),
            F.col("col.hit").alias("hit")),
        "pii-matches")


def _passes() -> Column:
    """Whether the match passes its kind's check."""
    digits = F.col("digits")
    small = F.forall(
        F.split("hit", r"\."),
        lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3,
                         F.concat(F.lit("0"), p).try_cast("decimal(38,0)") <= 255).otherwise(False))
    place = F.sequence(F.lit(1), F.length(digits))
    luhn = F.aggregate(
        place, F.lit(0),
        lambda s, i: s + F.substring(F.lit("01234567890246813579"), (F.substring(digits, -i, F.lit(1)).cast("int")
                         + F.when(i % 2 == 0, F.lit(11)).otherwise(F.lit(1))), F.lit(1)).cast("int"))
    card = F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), luhn % 10 == 0)
    number = {"email": F.lit(True), "ip": F.coalesce(small, F.lit(False)), "card": card,
              "phone": F.length(digits).between(9, 15)}
    return F.coalesce(_of_kind(number, lambda c: c), F.lit(False))


def _votes() -> list[Column]:
    """The labelers' votes, in the order of ``LABELERS``."""
    spelt = F.col("hit").rlike(r"[\[(]")
    before, after = F.right("tail", F.lit(1)), F.coalesce("head", F.lit(""))
    glued = before.rlike(r"[\p{L}0-9]") | after.rlike(r"[\p{L}0-9]")
    kinds = F.array_size(F.array_distinct(F.split(F.left("digits", F.lit(64)), "")))
    base = F.when(F.col("base"), 1).when(F.col("base_hit"), -1).otherwise(0)
    email = F.col("kind") == 0
    place = F.when(email, F.right("hit", F.lit(64))).otherwise(F.left("hit", F.lit(64)))
    known = _of_kind(_KNOWN, lambda p: place.rlike(p))
    return [
        _vote(F.col("check"), 1, -1),
        # no proper span is longer, and the patterns' loops are recursive
        _vote(F.when(F.length("hit") <= 320, _of_kind(_STRICT, lambda p: F.col("hit").rlike(p))), 1, -1),
        F.when(email & spelt, F.lit(0)).otherwise(_vote(known, 1, -1)),
        _vote(_of_kind(_CUES, lambda p: F.col("tail").rlike(p)), 1, 0),
        _vote(F.right("tail", F.lit(20)).rlike(_COUNTER_CUES), -1, 0),
        _vote(glued, -1, 1),
        base,
        _vote(~email & (F.length("digits") >= 8) & (kinds <= 2), -1, 0),
    ]


def _features() -> Column:
    """Slots of the candidate's own features, without any labeler's vote."""
    shape = F.regexp_replace(F.regexp_replace("hit", "[0-9]", "9"), r"\p{L}", "a")
    email_or_ip = F.col("kind") <= 1
    shape = F.when(email_or_ip, F.regexp_replace(F.regexp_replace(shape, "9+", "9"), "a+", "a")).otherwise(shape)
    words = F.split(F.trim(F.lower(F.regexp_replace("tail", r"[^\p{L}]+", " "))), " ")
    edge = [F.when(c == "", "^").when(c.rlike(r"\p{L}"), "a").when(c.rlike("[0-9]"), "9").otherwise(c)
            for c in (F.right("tail", F.lit(1)), F.coalesce("head", F.lit("")))]
    ending = F.when(email_or_ip, F.lower(F.substring_index("hit", ".", -1))).otherwise(F.left("digits", F.lit(2)))
    tokens = {"shape": F.left(shape, F.lit(64)), "check": F.col("check").cast("string"), "left": edge[0],
              "right": edge[1], "ending": ending, "length": F.when(email_or_ip, F.least(F.length("hit"), F.lit(40)).cast("string")).otherwise(""),
              "word": F.element_at(words, -1), "word before": F.coalesce(F.get(words, F.size(words) - 2), F.lit(""))}
    return F.array(*[F.pmod(F.xxhash64(F.lit(name), token), F.lit(SLOTS)).cast("int") for name, token in tokens.items()])


def candidates(found: DataFrame) -> DataFrame:
    """Base spans and other candidates, one row for each kind and place.

    From :func:`matches`: ``row``, ``kind``, ``start``, ``end`` (code points,
    end exclusive), ``base`` (is a base span), ``touches`` (overlaps a base
    span of any kind), ``votes`` and ``features``.
    """
    by = Window.partitionBy("row", "kind", "wide").orderBy("pos")
    size = F.length("hit")
    before = F.sum(F.col("gap") + F.coalesce(size, F.lit(0))).over(
        by.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + F.col("gap")
    placed = (
        found.where("kind >= 0").drop("_id").repartition("row")
        .select("row", "kind", "wide", "hit", "tail", start.alias("start"), (start + size).alias("end"),
                F.lead("head").over(by).alias("head"))
        .where("hit IS NOT NULL")
        .withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
    )
    checked = placed.withColumn("check", _passes())
    spans = checked.groupBy("row", "kind", "start", "end").agg(
        F.bool_or(F.col("check") & ~F.col("wide")).alias("base"), F.bool_or(~F.col("wide")).alias("base_hit"),
        F.first("check").alias("check"), F.first("hit").alias("hit"), F.first("digits").alias("digits"),
        F.max("tail").alias("tail"), F.max("head").alias("head"))
    along = Window.partitionBy("row").orderBy("start")
    ended = F.max(F.when(F.col("base"), F.col("end"))).over(along.rangeBetween(Window.unboundedPreceding, 0))
    begins = F.min(F.when(F.col("base"), F.col("start"))).over(along.rangeBetween(0, Window.unboundedFollowing))
    touches = F.coalesce(ended > F.col("start"), F.lit(False)) | F.coalesce(begins < F.col("end"), F.lit(False))
    return write_through(
        spans.withColumn("touches", touches).select(
            "row", "kind", "start", "end", "base", "touches", F.array(*_votes()).alias("votes"),
            _features().alias("features")),
        "pii-candidates")


@dataclass(frozen=True)
class Reliabilities:
    """How likely true and false candidates of each kind get each vote."""

    prior: list[float]  # share of true candidates, by kind
    votes: dict[tuple[int, int, int], tuple[float, float]]  # (kind, labeler, vote): if true, if false

    def posterior(self) -> Column:
        """Probability that a candidate (``kind``, ``votes``) is true."""
        n = len(LABELERS)
        table = [
            math.log(t / f) for k in range(len(KINDS)) for i in range(n) for v in (-1, 0, 1)
            for t, f in [self.votes[k, i, v]]
        ]
        weights, prior = F.lit(table), F.lit([math.log(p / (1 - p)) for p in self.prior])
        logit = F.aggregate(
            F.sequence(F.lit(0), F.lit(n - 1)), F.get(prior, F.col("kind")),
            lambda s, i: s + F.get(weights, F.col("kind") * (3 * n) + i * 3 + F.get("votes", i) + 1))
        return 1 / (1 + F.exp(-logit))


def first_guess() -> Reliabilities:
    """Every labeler is right more often than not, and true and false are as frequent."""
    guess = {-1: (0.1, 0.6), 0: (0.3, 0.3), 1: (0.6, 0.1)}
    return Reliabilities(
        [0.5] * len(KINDS),
        {(k, i, v): guess[v] for k in range(len(KINDS)) for i in range(len(LABELERS)) for v in guess})


def estimate(patterns: DataFrame, steps: int = STEPS) -> Reliabilities:
    """Expectation-maximisation on ``patterns`` (kind, votes, n).

    Each step counts, for both truths, the votes that the present estimate
    expects; one candidate's weight is added to every count.
    """
    now = first_guess()
    for _ in range(steps):
        p = F.col("_p")
        rows = (
            patterns.withColumn("_p", now.posterior())
            .select("kind", "n", "_p", F.posexplode("votes").alias("labeler", "vote"))
            .groupBy("kind", "labeler", "vote")
            .agg(F.sum(F.col("n") * p).alias("t"), F.sum(F.col("n") * (1 - p)).alias("f")).collect()
        )
        counts = {(r["kind"], r["labeler"], r["vote"]): (r["t"], r["f"]) for r in rows}
        votes, prior = {}, []
        for k in range(len(KINDS)):
            for i in range(len(LABELERS)):
                own = [counts.get((k, i, v), (0.0, 0.0)) for v in (-1, 0, 1)]
                true, false = (sum(c[side] for c in own) + 1.5 for side in (0, 1))
                for v, (t, f) in zip((-1, 0, 1), own, strict=True):
                    votes[k, i, v] = ((t + 0.5) / true, (f + 0.5) / false)
            prior.append(true / (true + false))
        after = Reliabilities(prior, votes)
        moved = max(abs(a - b) for key in votes for a, b in zip(votes[key], now.votes[key], strict=True))
        now = after
        if moved < SETTLED:
            break
    return now


def learn_spans(found: DataFrame, reliabilities: Reliabilities) -> DataFrame:
    """(kind, prior, weights): the classifier, one row a kind.

    A weight is the log-odds of true candidates among those with a feature,
    less those among all, shrunk to 0 for rare features.  ``found`` are the
    candidates; each counts for both truths by its posterior.
    """
    p = F.col("_p")
    judged = found.select("kind", "features", reliabilities.posterior().alias("_p"))
    sums = (
        judged.select("kind", "_p", F.explode(F.array_distinct(F.array_append("features", F.lit(SLOTS)))).alias("slot"))
        .groupBy("kind", "slot").agg(F.sum(p).alias("t"), F.sum(1 - p).alias("f"))
    )
    sums = write_through(sums, "pii-sums")
    whole = sums.where(F.col("slot") == SLOTS).select(
        "kind", ((F.col("t") + 1) / (F.col("t") + F.col("f") + 2)).alias("share"))
    slots = found.sparkSession.range(len(KINDS) * SLOTS).select(
        F.expr(f"cast(id div {SLOTS} as int)").alias("kind"), F.expr(f"cast(id % {SLOTS} as int)").alias("slot"))
    prior = F.log(F.col("share") / (1 - F.col("share")))
    t = F.coalesce("t", F.lit(0.0)) + _SHRINK * F.col("share")
    f = F.coalesce("f", F.lit(0.0)) + _SHRINK * (1 - F.col("share"))
    weighed = (
        slots.join(F.broadcast(sums), ["kind", "slot"], "left").join(F.broadcast(whole), "kind")
        .select("kind", "slot", prior.alias("prior"), (F.log(t / f) - prior).alias("w"))
    )
    listed = weighed.groupBy("kind").agg(
        F.first("prior").alias("prior"), F.array_sort(F.collect_list(F.struct("slot", "w"))).alias("w"))
    return write_through(listed.select("kind", "prior", F.col("w.w").alias("weights")), "pii-classifier")


def judge_spans(found: DataFrame, classifier: DataFrame) -> DataFrame:
    """``found`` with ``score``: the classifier's probability of the candidate."""
    logit = F.aggregate(
        F.array_distinct("features"), F.col("prior"), lambda s, slot: s + F.get("weights", slot))
    return found.join(F.broadcast(classifier), "kind").withColumn("score", 1 / (1 + F.exp(-logit))).drop(
        "prior", "weights")


def find_personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", add_at: float = ADD_AT,
) -> DataFrame:
    """One row per row of ``docs``: its spans of personal data.

    Returns ``id_col`` and ``spans``, an array of ``kind`` (place in
    ``KINDS``), ``start``, ``end`` (code points, end exclusive), ``base`` and
    ``score`` (the span classifier's probability), sorted by kind and start.
    Base spans are always there; a candidate is added if its score is
    ``add_at`` or more and it overlaps no base span.  Added spans of one kind
    and pattern do not overlap each other; those of different kinds may.

    Null and empty texts have no spans.  Rows that repeat an id, or have
    none, are documents of their own; equal texts have equal spans.  Texts of
    any length are searched whole, in time linear in their length and number
    of matches.  Other columns are ignored; an empty table gives an empty
    result.  Without candidates of a kind nothing of it is added.
    """
    found = matches(docs, id_col, text_col)
    spans = candidates(found)
    patterns = write_through(spans.groupBy("kind", "votes").agg(F.count("*").alias("n")), "pii-votes")
    classifier = learn_spans(spans, estimate(patterns))
    judged = judge_spans(spans, classifier).where(
        F.col("base") | ((F.col("score") >= add_at) & ~F.col("touches")))
    span = F.struct("kind", "start", "end", "base", "score")
    rows = found.where("kind < 0").select("row", "_id", F.lit(None).cast(judged.select(span.alias("s")).schema["s"].dataType).alias("s"))
    kept = judged.select("row", F.lit(None).cast(found.schema["_id"].dataType).alias("_id"), span.alias("s"))
    return (
        rows.unionByName(kept).groupBy("row")
        .agg(F.max("_id").alias(id_col), F.array_sort(F.collect_list("s")).alias("spans")).drop("row")
    )


def listing(spans: str) -> str:
    """SQL: ``kind:start:end`` of an array of spans, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')"
