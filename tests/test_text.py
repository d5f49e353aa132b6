import re

import pytest
from pyspark.sql import functions as F

from wardflow.functions import lexicons as L
from wardflow.functions import text as X
from wardflow.operators import phrases
from wardflow.operators.summarize import summarize

# Complaints of the usual shapes: what, since when, how strong.
URGENT = "Paciente com dor torácica aguda há 50 minutos, palidez e falta de ar"
FEVER = "Chegou com febre alta há 4 dias e muita tosse"
ROUTINE = "Consulta de acompanhamento de rotina, tudo bem"


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text,label", [
    (URGENT, "urgente"), (FEVER, "alta"), (ROUTINE, "eletiva"), ("", "eletiva"), (None, None),
    ("Queixa de dor de garganta há 5 dias", "media")])
def test_priority(spark, text, label):
    assert one(spark, X.classify(F.col("t"), L.PRIORITY, L.PRIORITY_DEFAULT), text) == label


def test_tie_goes_to_the_first_label_and_weights_count(spark):
    lexicon = {"a": {"um": 1.0}, "b": {"dois": 1.0}, "c": {"tres": 2.5}}
    label = X.classify(F.col("t"), lexicon, "z")
    assert one(spark, label, "dois um") == "a"
    assert one(spark, label, "dois um dois") == "b"
    assert one(spark, label, "um um tres") == "c"
    assert one(spark, label, "umdois tresum") == "z"


def test_overlapping_terms_all_count(spark):
    lexicon = {"a": {"dor": 1.0, "dor de": 1.0, "de ar": 1.0}, "b": {"ar": 2.5}}
    assert one(spark, X.classify(F.col("t"), lexicon, "z"), "Dor de ar") == "a"
    assert one(spark, X.classify(F.col("t"), {"a": {"ha ha": 1.0}, "b": {"x": 1.5}}, "z"),
               "ha ha ha x") == "a"


@pytest.mark.parametrize("text,label", [
    ("Foi tudo excelente, gente atenciosa", "positive"),
    ("Achei péssimo do começo ao fim", "negative"),
    ("Lugar limpo, porém o serviço foi péssimo", "mixed"),
    ("Estive aqui na terça", "neutral"), ("", "neutral"), (None, None)])
def test_sentiment(spark, text, label):
    assert one(spark, X.sentiment(F.col("t"), L.POSITIVE, L.NEGATIVE), text) == label


def test_labels_stay_in_the_closed_set(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for lexicon, default in ((L.PRIORITY, L.PRIORITY_DEFAULT), (L.RISK, L.RISK_DEFAULT),
                             (L.THEME, L.THEME_DEFAULT), (L.CRITICALITY, L.CRITICALITY_DEFAULT)):
        found = {r[0] for r in docs.select(X.classify(F.col("text"), lexicon, default)).collect()}
        assert found <= set(lexicon)


def test_extract_symptoms(spark):
    found = one(spark, X.extract_fields(F.col("t"), X.SYMPTOM_FIELDS), URGENT)
    assert found.asDict() == {"sintoma_principal": "dor torácica aguda", "duracao": "50 minutos",
                              "intensidade": "aguda"}
    found = one(spark, X.extract_fields(F.col("t"), X.SYMPTOM_FIELDS), "Exame periódico da empresa")
    assert found["duracao"] is None and found["intensidade"] is None
    assert one(spark, X.extract_fields(F.col("t"), X.SYMPTOM_FIELDS), None) is None


def test_mask(spark):
    text = "Ligar para Iara Prado no (31) 90000-1234; documento 000.111.222-33, retorno em maio"
    column = X.mask(F.col("t"), ["person", "phone", "national_id"], ["Iara", "Prado"])
    assert one(spark, column, text) == (
        "Ligar para [MASKED] no [MASKED]; documento [MASKED], retorno em maio")
    assert one(spark, column, "sem dados") == "sem dados"
    assert one(spark, column, "Iarazinha fica") == "Iarazinha fica"
    assert one(spark, column, None) is None


def test_names_are_no_patterns(spark):
    column = X.mask(F.col("t"), ["person"], ["J.", "Ana", "Ana Lia"])
    assert one(spark, column, "Jo e J. viram Ana Lia e Ana") == "Jo e [MASKED] viram [MASKED] e [MASKED]"


def test_mask_leaves_nothing_behind(spark):
    every = ["email", "national_id", "phone", "ip"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    masked = docs.select(X.mask(F.col("text"), every).alias("m"))
    assert masked.where(X.contains_personal_data(F.col("m"), every)).count() == 0


def test_email_matching_equals_the_plain_pattern(spark):
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    texts = ["a@b.com", "x a@b.com_c@d.org y", "@b.com", "a@b", "..a@b.co.uk.", "a@b.com@c.de",
             "a" * 5000 + " b@c.de", "a%b+c@d-e.fr,g@h.ij"]
    for text in texts:
        assert one(spark, F.regexp_replace(F.col("t"), X.EMAIL, "#"), text) == plain.sub("#", text)


def test_jaccard_and_cosine(spark):
    pair = spark.createDataFrame([("a b c", "a b c"), ("a b", "c d"), ("", ""), ("a b c", "B, C d"),
                                  (None, "a")], "l string, r string")
    assert [r[0] for r in pair.select(X.jaccard(F.col("l"), F.col("r"))).collect()] == [
        1.0, 0.0, 0.0, 0.5, None]
    vectors = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]),
                                     ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in vectors.select(X.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None]


def test_join_form_equals_column_form(spark, rows):
    lexicon = {"dor": {"dor": 1.0, "dor de cabeça": 2.0}, "ar": {"falta de ar": 3.0, "ar": 0.5},
               "ha": {"ha ha": 1.5}}
    # Terms that fold to one add up; weights of a tenth do not round.
    lexicon |= {"q": {"médico": 0.1, "medico": 0.2}, "r": {"sala": 0.3}}
    texts = [(1, "Dor de cabeça e dor"), (2, "falta de ar"), (3, "nada"), (4, None), (5, ""),
             (6, "ha ha ha dor dor dor"), (7, "ar ar dor"), (8, "medico sala"), (9, "sala sala médico"),
             (10, "medico " * 10 + "sala " * 10)]
    docs = spark.createDataFrame(texts, "id int, text string")
    table = spark.createDataFrame(
        [(i, label, t, w) for i, (label, terms) in enumerate(lexicon.items()) for t, w in terms.items()],
        "position int, label string, term string, weight double")
    column = docs.select("id", X.classify(F.col("text"), lexicon, "outro"))
    for most in AUTOMATON.values():
        assert rows(phrases.classify_by_lexicon(docs, "id", "text", table, "outro", automaton_bytes=most)) == rows(column)


def bag(text):
    return frozenset(re.findall("[a-z0-9]+", text.lower()))


def brute_force(texts, catalogue, threshold):
    """(text, least key of the equal phrases, their number) by comparing everything."""
    entries = {}
    for j, phrase in catalogue:
        entries.setdefault(bag(phrase), []).append(j)
    return {(i, min(keys), len(keys)) for i, t in texts for b, keys in entries.items()
            if bag(t) and b and len(bag(t) & b) / len(bag(t) | b) >= threshold}


@pytest.mark.parametrize("threshold", [0.2, 0.5, 2 / 3, 0.75, 1.0])
def test_phrase_matching_equals_brute_force(spark, threshold):
    import random
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [(i, " ".join(rng.choices(vocabulary[:8 + i % 20], k=rng.randint(0, 8)))) for i in range(120)]
    # A third of all texts are copies of one, and one word is in nearly every phrase.
    texts += [(1000 + i, "w1 w2 w3") for i in range(60)]
    catalogue = [(i, "w1 " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 5)))) for i in range(40)]
    catalogue += [(500 + i, "w3 w2 w1 w1") for i in range(20)]
    left = spark.createDataFrame(texts, "id int, text string")
    right = spark.createDataFrame(catalogue, "code int, phrase string")
    found = phrases.match_phrases(left, "id", "text", right, "code", "phrase", threshold)
    pairs = [(r["id"], r["code"], r["copias"]) for r in found.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute_force(texts, catalogue, threshold)


AUTOMATON = {"automaton": None, "join": -1}


def column_mask(spark, texts, names):
    docs = spark.createDataFrame(texts, "id int, t string")
    return docs.select("id", X.mask(F.col("t"), ["person"], names))


@pytest.mark.parametrize("most", AUTOMATON.values(), ids=list(AUTOMATON))
def test_mask_names_from_a_table(spark, rows, most):
    docs = spark.createDataFrame([(1, "Ana Lima viu Pedro"), (2, "Anabela"), (3, None), (1, "Ana Lima viu Pedro"),
                                  (4, "Ontem Maria Silva e Ana falaram"), (5, "Jean-Luc, Jean Luc.")], "id int, t string")
    names = spark.createDataFrame([("Ana",), ("Lima",), ("Pedro",), (None,), ("--",), (" Maria Silva.",),
                                   ("Jean-Luc",), ("Ana",)], "n string")
    masked = phrases.mask_names(docs, "id", "t", names, "n", X.MASK, most)
    assert rows(masked) == [(1, "[MASKED] viu [MASKED]"), (1, "[MASKED] viu [MASKED]"), (2, "Anabela"), (3, None),
                            (4, "Ontem [MASKED] e [MASKED] falaram"), (5, "[MASKED], Jean Luc.")]
    assert rows(phrases.mask_names(docs, "id", "t", names.limit(0), "n", X.MASK, most)) == rows(docs)


@pytest.mark.parametrize("most", AUTOMATON.values(), ids=list(AUTOMATON))
def test_names_of_one_to_five_words_equal_the_column_form(spark, rows, most):
    import random
    rng = random.Random(11)
    vocabulary = ["Ana", "Anab", "Li", "Lima", "da", "Sá", "É", "Ö", "x"]
    names = sorted({" ".join(rng.choices(vocabulary, k=rng.randint(1, 5))) for _ in range(60)} | {"Li-Li", "O'Li"})
    gaps = [" "] * 8 + ["  ", ", ", "-", ".", "", "'", " 2 ", "\n"]
    texts = [(i, "".join(w + rng.choice(gaps) for w in rng.choices(vocabulary, k=rng.randint(0, 25)))) for i in range(300)]
    docs = spark.createDataFrame(texts, "id int, t string")
    table = spark.createDataFrame([(n,) for n in names], "n string")
    found = phrases.mask_names(docs, "id", "t", table, "n", X.MASK, most)
    assert rows(found) == rows(column_mask(spark, texts, names))


def test_a_large_table_of_names(spark, rows):
    names = [(f"Nome {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)} Sobre{chr(97 + i // 17576)}",)
             for i in range(100_000)]
    texts = [(1, "Ontem Nome aaa Sobrea veio"), (2, "Nome aaa Sobrez"), (3, f"{names[-1][0]} {names[500][0]}, ok")]
    docs, table = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(names, "n string")
    expected = [(1, "Ontem [MASKED] veio"), (2, "Nome aaa Sobrez"), (3, "[MASKED], ok")]
    for most in AUTOMATON.values():
        assert rows(phrases.mask_names(docs, "id", "t", table, "n", X.MASK, most)) == expected


def test_summary_budget(spark):
    text = "Dor forte hoje. Sem febre. Dor forte de novo, dor. Outro assunto qualquer aqui!"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "um dois tres")], "id int, t string")
    for budget in (0, 1, 3, 8, 100):
        made = {r["id"]: r for r in summarize(docs, "id", "t", budget).collect()}
        assert set(made) == {1, 2, 3, 4}
        assert made[3]["resumo"] is None
        for r in (made[1], made[2], made[4]):
            assert r["n_palavras"] <= budget
            assert len(re.findall(r"\w+", r["resumo"])) == r["n_palavras"]
    # "dor" occurs three times, "forte" twice: the first sentence has the best mean.
    assert made[1]["resumo"] == ("Dor forte hoje. Sem febre. Dor forte de novo, dor. "
                                 "Outro assunto qualquer aqui")
    best = {r["id"]: r["resumo"] for r in summarize(docs, "id", "t", 3).collect()}
    assert best[1] == "Dor forte hoje"


def test_one_long_sentence_is_linear(spark):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, " ".join(f"w{i % 997}" for i in range(n)))], "id int, t string")
        start = time.perf_counter()
        assert summarize(docs, "id", "t", n).first()["n_palavras"] == n
        return time.perf_counter() - start

    seconds(1000)
    short = min(seconds(5000) for _ in range(2))
    assert min(seconds(20000) for _ in range(2)) < 2 * short + 1
