"""Text operators as native column expressions: no model, no Python worker.

Every operator is deterministic, gives NULL for NULL text, and matches whole words on
folded text: accents removed, lower case, split at everything but ASCII letters and digits. What a label means is decided by the lexicon the caller passes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent folding for Portuguese, Spanish, French and German letters.
TEXT_ACCENTS = "áàâãäåéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
TEXT_PLAIN = "aaaaaaeeeeiiiiooooouuuucnAAAAAAEEEEIIIIOOOOOUUUUCN"

MASK = "[MASKED]"

# Weights of lexicon terms have six decimals.
WEIGHT_UNIT, WEIGHT_TYPE = Decimal("0.000001"), "decimal(18,6)"
SCORE_TYPE = "decimal(38,6)"

Lexicon = Mapping[str, Mapping[str, float]]
"""label -> term -> weight, labels in the order that breaks ties."""


def words(text: Column) -> Column:
    """Array of folded words in text order; empty for text without any."""
    plain = F.lower(F.translate(text, TEXT_ACCENTS, TEXT_PLAIN))
    return F.array_remove(F.split(plain, "[^a-z0-9]+"), "")


def fold(text: Column) -> Column:
    """The folded text: its words, one blank between them."""
    return F.array_join(words(text), " ")


def fold_term(term: str) -> str:
    """The same folding for a lexicon term on the driver."""
    plain = term.translate(str.maketrans(TEXT_ACCENTS, TEXT_PLAIN)).lower()
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in plain).split())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _folded_terms(terms: Mapping[str, float]) -> dict[str, Decimal]:
    """Weight of each folded term; terms that fold to the same one add up, those without a
    letter or digit are left out. Weights are decimals, so that sums are exact in any order."""
    out: dict[str, Decimal] = {}
    for term, weight in terms.items():
        if folded := fold_term(term):
            out[folded] = out.get(folded, Decimal(0)) + Decimal(str(weight)).quantize(WEIGHT_UNIT)
    return out


def _mentions(found: Column, terms: Sequence[str]) -> Column:
    """Does any term occur among the words? Terms of several words must be consecutive."""
    single = [t for t in terms if " " not in t]
    several = [t for t in terms if " " in t]
    hit = F.lit(False)
    if single:
        hit = hit | F.arrays_overlap(found, F.array(*[F.lit(t) for t in single]))
    if several:
        hit = hit | F.array_join(found, " ").rlike(r"\b(?:" + "|".join(several) + r")\b")
    return hit


def _score(hits: Column, folded: Column | None, terms: Mapping[str, Decimal]) -> Column:
    """Sum of weight times occurrences.

    One-word terms are counted among ``hits``, the lexicon words found in the text. A term
    of several words is counted at every position where it starts, so that overlapping
    terms do not hide each other.
    """
    by_weight: dict[Decimal, list[str]] = {}
    score = F.lit(0).cast(SCORE_TYPE)
    for term, weight in terms.items():
        if " " in term:
            head, rest = term.split(" ", 1)
            starts = F.regexp_count(folded, F.lit(rf"\b{head}(?= {rest}\b)"))
            score = score + _times(starts, weight)
        else:
            by_weight.setdefault(weight, []).append(term)
    for weight, chosen in by_weight.items():
        score = score + _times(F.size(_among(hits, chosen)), weight)
    return score


def _times(count: Column, weight: Decimal) -> Column:
    return (count.cast("decimal(19,0)") * F.lit(weight).cast(WEIGHT_TYPE)).cast(SCORE_TYPE)


def _among(found: Column, chosen: Sequence[str]) -> Column:
    return F.filter(found, lambda word: word.isin(list(chosen)))


Rule = Callable[[Column], Column]
"""From the array of folded words to a label."""


def class_rule(lexicon: Lexicon, default: str) -> Rule:
    """Exactly one label: highest score, ties by label order, ``default`` without any hit."""
    plain = {label: _folded_terms(terms) for label, terms in lexicon.items()}
    single = sorted({t for terms in plain.values() for t in terms if " " not in t})
    several = any(" " in t for terms in plain.values() for t in terms)

    def best(hits: Column, folded: Column | None) -> Column:
        # Without hits the default entry is the greatest: score 0, place before all labels.
        entries = [_entry(F.lit(0).cast(SCORE_TYPE), 1, default)]
        entries += [_entry(_score(hits, folded, terms), -place, label)
                    for place, (label, terms) in enumerate(plain.items()) if terms]
        return F.array_max(F.array(*entries))["label"] if len(entries) > 1 else F.lit(default)

    def rule(found: Column) -> Column:
        hits = _among(found, single)
        if not several:
            return _let(hits, lambda h: best(h, None))
        return _let(F.struct(hits.alias("hits"), F.array_join(found, " ").alias("folded")),
                    lambda both: best(both["hits"], both["folded"]))

    return rule


def sentiment_rule(positive: Sequence[str], negative: Sequence[str]) -> Rule:
    """positive, negative, mixed (both kinds of terms) or neutral (neither)."""
    good, bad = [fold_term(t) for t in positive], [fold_term(t) for t in negative]

    def rule(found: Column) -> Column:
        # 1 neither, 2 only negative, 3 only positive, 4 both.
        kind = F.lit(1) + _mentions(found, good).cast("int") * 2 + _mentions(found, bad).cast("int")
        names = F.array(*[F.lit(n) for n in ("neutral", "negative", "positive", "mixed")])
        return F.element_at(names, kind)

    return rule


def label_all(text: Column, rules: Mapping[str, Rule]) -> Column:
    """Struct with one label per rule; the text is split into words once for all of them."""
    def apply(found: Column) -> Column:
        return F.struct(*[rule(found).alias(name) for name, rule in rules.items()])

    return F.when(text.isNotNull(), _let(words(text), apply))


def classify(text: Column, lexicon: Lexicon, default: str) -> Column:
    """The label of :func:`class_rule`; NULL for NULL text."""
    return label_all(text, {"label": class_rule(lexicon, default)})["label"]


def sentiment(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """The label of :func:`sentiment_rule`; NULL for NULL text."""
    return label_all(text, {"label": sentiment_rule(positive, negative)})["label"]


def _entry(score: Column, place: int, label: str) -> Column:
    return F.struct(score.cast(SCORE_TYPE).alias("score"), F.lit(place).alias("place"), F.lit(label).alias("label"))


def sentiment_score(label: Column) -> Column:
    """+1, -1, 0 for averages."""
    return (
        F.when(label == "positive", 1)
        .when(label == "negative", -1)
        .when(label.isNotNull(), 0)
    )


# An address starts where its run of name characters starts (or where the match before it
# ended), and the run is never given back: linear time on long runs without an "@".
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_BR = r"\([0-9]{2}\) ?9?[0-9]{4}-[0-9]{4}"
PHONE_US = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
CPF = r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"
RG = r"[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9]"
CNS = r"700 [0-9]{4} [0-9]{4} [0-9]{3}"

# Order matters: a longer number format goes before one that could match inside it.
ENTITIES: dict[str, list[str]] = {
    "email": [EMAIL],
    "national_id": [CPF, CNS, RG],
    "phone": [PHONE_US, PHONE_BR],
    "ip": [IPV4],
}

# Shapes of free-text complaints: what, since when, how strong.
SYMPTOM_FIELDS = {
    "sintoma_principal": r"^(?:Paciente com )?(.+?)(?: há |,| com |$)",
    "duracao": r"há ([0-9]+ [a-zê]+)",
    "intensidade": r"(?i)\b(leve|moderad[ao]|forte|sever[ao]|agud[ao]|crônic[ao]|súbit[ao]|constante|latejante)\b",
}


def extract_fields(text: Column, fields: Mapping[str, str]) -> Column:
    """Struct with the first match of each pattern (its group 1 if it has one), NULL if absent."""
    found = []
    for name, pattern in fields.items():
        group = 1 if _has_group(pattern) else 0
        found.append(F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).alias(name))
    return F.when(text.isNotNull(), F.struct(*found))


def _has_group(pattern: str) -> bool:
    return re.search(r"(?<!\\)\((?!\?)", pattern) is not None


def mask(text: Column, entities: Sequence[str], names: Sequence[str] = ()) -> Column:
    """Replace personal data by a fixed mark. ``person`` masks runs of the given names."""
    masked = text
    for kind in (k for k in ENTITIES if k in entities):
        for pattern in ENTITIES[kind]:
            masked = F.regexp_replace(masked, pattern, MASK)
    if "person" in entities:
        if not names:
            raise ValueError("masking persons needs a list of names")
        # Longer names first: of two that begin alike, the whole one is masked.
        name = "(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")"
        masked = F.regexp_replace(masked, rf"(?<!\p{{L}}){name}(?: {name})*(?!\p{{L}})", MASK)
    return masked


def contains_personal_data(text: Column, entities: Sequence[str]) -> Column:
    return text.rlike("|".join(p for k in ENTITIES if k in entities for p in ENTITIES[k]))


def jaccard(left: Column, right: Column) -> Column:
    """Similarity of two texts as sets of folded words: 0..1, and 0 when both have none."""
    sets = F.struct(F.array_distinct(words(left)).alias("a"), F.array_distinct(words(right)).alias("b"))

    def ratio(both: Column) -> Column:
        common = F.size(F.array_intersect(both["a"], both["b"])).cast("double")
        return _let(F.struct(common.alias("common"),
                             (F.size(both["a"]) + F.size(both["b"]) - common).alias("union")),
                    lambda n: F.when(n["union"] > 0, n["common"] / n["union"]).otherwise(F.lit(0.0)))

    return F.when(left.isNotNull() & right.isNotNull(), _let(sets, ratio))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two number arrays, in double arithmetic; NULL if one has length 0."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
