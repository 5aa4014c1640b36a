"""Planted questions, re-parameterised ones, and frames that only look alike."""

from __future__ import annotations

import random

from gridtide.llm.decontamination import contaminated, drop_contaminated

QUESTION = (
    "On Monday the farmer Alice sold 12 kg of ripe plums to her neighbour Bob and then walked "
    "5 km home with Bob before she counted the 12 coins that were left in the old purse."
)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc string")


def test_planted(spark, documents):
    rng = random.Random(4)

    def filler(n):
        return " ".join(f"word{rng.randrange(3000)}" for _ in range(n))

    other = QUESTION.replace("Alice", "Clara").replace("Bob", "Dan").replace("12", "7").replace("5 km", "9 miles")
    mixed = other.replace("7 coins", "8 coins")
    half = " ".join(QUESTION.split()[:12])
    plain = filler(30)
    rows = [
        (1, filler(80) + " " + QUESTION + " " + filler(50)),
        (2, filler(10) + " " + other + " " + filler(10)),
        (3, filler(10) + " " + mixed + " " + filler(10)),
        (4, filler(10) + " " + half + " " + filler(10)),
        (5, plain), (6, filler(300)), (7, ""), (8, None), (None, QUESTION),
        (9, filler(20_000) + " " + QUESTION.upper().lower()),
        (10, "12 kg 5 km " * 50), (11, QUESTION), (11, QUESTION), (11, "clean text of the same id"),
        (12, "only four words here"), (13, filler(5) + " only four words here, " + filler(5)),
    ]
    items = benchmark(spark, [(100, QUESTION, "x"), (200, plain, "x"), (201, plain, "x"),
                              (300, "Only four words here.", "x"), (301, None, "x"), (None, "a b c d e f g h i", "x")])
    docs = documents([(*r, "x", "y") for r in rows], ("item_id", "window")).repartition(3)
    got = sorted((r.doc, r.item_id) for r in contaminated(docs, items).collect())
    assert got == [(1, 100), (2, 100), (5, 200), (5, 201), (9, 100), (11, 100), (12, 300), (13, 300)]
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    ids = sorted((-1 if r.doc_id is None else r.doc_id) for r in left.collect())
    assert ids == [-1, 3, 4, 6, 7, 8, 10, 11]


def test_empty_tables(spark, documents):
    items = benchmark(spark, [(1, QUESTION, "x")])
    assert contaminated(documents([]), items).count() == 0
    docs = documents([(1, QUESTION)])
    assert contaminated(docs, items.limit(0)).count() == 0
    assert drop_contaminated(docs, items.limit(0)).count() == 1


def held(spark, documents, item, texts):
    docs = documents(list(enumerate(texts)))
    return sorted(r.doc for r in contaminated(docs, benchmark(spark, [(1, item, "x")])).collect())


def test_numbers_alone_are_found_as_they_stand(spark, documents):
    item = "Sort 3 5 9 1 4 7 2 8"
    texts = [item, "so: sort 3 5 9 1 4 7 2 8.", "Sort 3 5 9 1 4 7 2 9", "Sort 1 2 3 4 5 6 7 8", item.upper()]
    assert held(spark, documents, item, texts) == [0, 1, 2, 4]  # in 2 one of two windows


def test_names_at_the_beginning_of_sentences(spark, documents):
    item = "Alice has 12 apples. Bob gives Alice 5 more. How many apples does Alice have now?"
    other = "Clara has 30 apples. Dan gives Clara 7 more. How many apples does Clara have now?"
    wrong = "Clara has 30 apples. Dan gives Eve 7 more. How many apples does Fay have now?"
    texts = [item, item.lower(), item.upper(), other, "Look. " + other + " Well?", wrong,
             "A man has apples. How many does he have now, and how many does she have?"]
    assert held(spark, documents, item, texts) == [0, 1, 2, 3, 4]


def test_a_run_of_words_is_enough(spark, documents):
    words = [f"item{i}" for i in range(60)]
    texts = [" ".join(["x"] + words[20:20 + n] + ["y"]) for n in (8, 12, 13, 20)]
    assert held(spark, documents, " ".join(words), texts) == [2, 3]


def brute(item, text, window=8, min_share=0.5, min_run=13):
    """Verbatim windows and runs of plain lower-case words, by looking at all places."""
    a, b = item.split(), text.split()
    if len(a) < window:
        return bool(a) and any(b[i: i + len(a)] == a for i in range(len(b)))
    places = range(len(a) - window + 1)
    found = {i for i in places if any(b[j: j + window] == a[i: i + window] for j in range(len(b)))}
    run = max((n for n in range(window, len(a) + 1) for i in range(len(a) - n + 1)
               if any(b[j: j + n] == a[i: i + n] for j in range(len(b)))), default=0)
    return len(found) >= min_share * len(places) or run >= min_run


def test_against_brute_force(spark, documents):
    rng = random.Random(9)
    items = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 40))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [" ".join(rng.choices("abcdefghij", k=rng.randrange(12)))]
        for item in rng.sample(items, 2):
            words = item.split()
            begin = rng.randrange(len(words))
            parts += [" ".join(words[begin: begin + rng.randrange(40)]), " ".join(rng.choices("ij", k=3))]
        texts.append(" ".join(parts))
    docs = documents(list(enumerate(texts))).repartition(3)
    bench = benchmark(spark, [(i, t, "x") for i, t in enumerate(items)])
    got = {(r.doc, r.item_id) for r in contaminated(docs, bench).collect()}
    assert got == {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if brute(item, t)}
