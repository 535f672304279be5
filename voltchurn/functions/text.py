"""Text enrichment expressions (X1, X3, X5) and the sentiment scorer hook.

Intent classification is an ordered list of (label, regex) rules applied as a
single CASE chain of ``rlike`` tests: JVM-side, whole text, first match wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltchurn.constants import (
    INTENT_ACCOUNT,
    INTENT_BILLING,
    INTENT_CANCEL,
    INTENT_COMPLAINT,
    INTENT_GENERAL,
    INTENT_OTHER,
    INTENT_PLAN,
    INTENT_PRICING,
    INTENT_RENEWAL,
)

# ---------------------------------------------------------------------------
# Intent rules, in priority order (first matching label wins).
# Each label's patterns are alternatives, matched case-insensitively anywhere
# in the text.
# ---------------------------------------------------------------------------
INTENT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (INTENT_CANCEL, (
        r"\bcancel(l?ed|lation)?\b",
        r"\bterminate\b",
        r"\bswitch(ing)?\b",
        r"\bleave\b",
        r"\baccount clos(e|ure)\b",
        r"\bclosing account\b",
    )),
    (INTENT_COMPLAINT, (
        r"\bcomplain(t|ing)?\b",
        r"\bfrustrat(ed|ion)\b",
        r"\bescalat(ed|ion)\b",
        r"\bnot satisfied\b",
        r"\bunsatisfied\b",
        r"\bupset\b",
        r"\bdissatisf(ied|action)\b",
        r"\bunhappy\b",
        r"\bdiscontent\b",
    )),
    (INTENT_BILLING, (
        r"\bbill(ing)?\b",
        r"\bcharge(s|d)?\b",
        r"\bpayment\b",
        r"\boverdue\b",
        r"\bpast due\b",
    )),
    (INTENT_RENEWAL, (
        r"\brenew(al|als|ing)?\b",
        r"\bexpir(e|y|ation)\b",
        r"\bnext renewal\b",
        r"\brenewals discussed\b",
        r"\brenewed\b",
        r"\brenewed contract\b",
    )),
    (INTENT_PRICING, (
        r"\bprice(s|d)?\b",
        r"\brate(s)?\b",
        r"\bpricing\b",
        r"\bincrease\b",
        r"\bhike\b",
        r"\bdiscount(s)?\b",
        r"\bsavings?\b",
        r"\bcompetitive\b",
        r"\bbetter (deal|rate|offer)\b",
        r"\bcompetitiveness\b",
        r"\bcompetition\b",
        r"\balternatives?\b",
        r"\bseeking alternatives?\b",
        r"\blooking around\b",
    )),
    (INTENT_PLAN, (
        r"\bplan(s)?\b",
        r"\bplan options?\b",
        r"\bnew plan\b",
        r"\bfuture plans?\b",
        r"\boptions?\b",
        r"\bexploring options?\b",
    )),
    (INTENT_ACCOUNT, (
        r"\baccount details?\b",
        r"\baccount questions?\b",
        r"\bservices?\b",
        r"\binquir(y|ed|ies)\b",
        r"\binfo\b",
        r"\bclarified\b",
        r"\bprovided info\b",
        r"\breviewed options\b",
        r"\bdiscussed options\b",
        r"\baccount update(s)?\b",
        r"\baccount setup\b",
        r"\bsetup details?\b",
        r"\baccount issues?\b",
        r"\baccount\b.*\bno issues\b",
        r"\bno issues found\b",
        r"\ball good\b",
    )),
    (INTENT_GENERAL, (
        r"\bgeneral\b",
        r"\bfollow[- ]?up\b",
        r"\broutine\b",
        r"\binbound call\b",
        r"\bno action required\b",
        r"\bissue resolved\b",
        r"\bresolved\b",
        r"\bnormal process\b",
        r"\bstandard interaction\b",
        r"\bcustomer contacted\b",
    )),
)

# Python's whitespace set (what ``str.strip`` removes), as one regex class.
_WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"


def rule_pattern(patterns: Sequence[str]) -> str:
    """One case-insensitive alternation for a label.

    ``(?d)`` makes ``\\n`` the only line end, so ``.`` behaves as in Python.
    When every alternative is wrapped in word boundaries, the boundaries are
    hoisted out (``\\b(?:a|b)\\b``): the same matches, but alternatives are
    only tried where a word starts, which is several times cheaper on long
    texts.
    """
    b = r"\b"
    if patterns and all(p.startswith(b) and p.endswith(b) and not p.endswith("\\" + b) for p in patterns):
        inner = "|".join(f"(?:{p[2:-2]})" for p in patterns)
        return f"(?id){b}(?:{inner}){b}"
    return "(?id)" + "|".join(f"(?:{p})" for p in patterns)


def classify_intent(text, rules: Sequence[tuple[str, Sequence[str]]] = INTENT_RULES,
                    other: str = INTENT_OTHER) -> Column:
    """First label whose rule matches the whole text; NULL text counts as ''."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    expr = None
    for label, pats in rules:
        cond = t.rlike(rule_pattern(pats))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other)) if expr is not None else F.lit(other)


def is_blank(text) -> Column:
    """NULL, empty, or whitespace only (Unicode whitespace, like ``str.strip``)."""
    t = F.col(text) if isinstance(text, str) else text
    return t.isNull() | t.rlike("^" + _WS_CLASS + "*$")


def has_interaction(date_col, text_col) -> Column:
    """A date is present or the text is not blank -> 1, else 0."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return (d.isNotNull() | ~is_blank(text_col)).cast("int")


# ---------------------------------------------------------------------------
# Sentiment.  The reference scores texts with a pretrained transformer whose
# weights are not available offline.  The default scorer below is a small
# word-list stand-in, computed in column expressions; a real model plugs in
# through ``plans.enrich.sentiment(df, scorer=...)`` (mapInPandas).
# ---------------------------------------------------------------------------
POSITIVE_WORDS = ("good", "great", "happy", "satisfied", "thanks", "thank", "excellent",
                  "helpful", "pleased", "resolved", "love", "perfect")
NEGATIVE_WORDS = ("bad", "poor", "angry", "upset", "complaint", "cancel", "terrible",
                  "problem", "unhappy", "frustrated", "wrong", "worst")
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def word_hits(text, words: Sequence[str]) -> Column:
    """Number of tokens of the whole lower-cased text that are in ``words``.

    A token is a maximal run of letters, digits and ``_``; a regex match of
    a listed word with no token character on either side is exactly one such
    token, so one codegen'd ``regexp_count`` replaces split + filter.
    """
    t = F.col(text) if isinstance(text, str) else text
    w = "|".join(words)
    pat = f"(?<![\\p{{L}}\\p{{N}}_])(?:{w})(?![\\p{{L}}\\p{{N}}_])"
    return F.coalesce(F.regexp_count(F.lower(t), F.lit(pat)), F.lit(0))


def sentiment_label(neg, neu, pos) -> Column:
    """Arg-max label; ties go to negative, then neutral, then positive."""
    neg, neu, pos = (F.col(c) if isinstance(c, str) else c for c in (neg, neu, pos))
    return (F.when((neg >= neu) & (neg >= pos), F.lit("negative"))
            .when(neu >= pos, F.lit("neutral"))
            .otherwise(F.lit("positive")))
