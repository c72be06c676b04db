"""Re-parameterised questions: 200 variants with other names, numbers and units, wherever these stand, and clean texts."""

import random

from folioflow.llm import decontam

NAMES = "Anna Peter Maria Robert Sofia Julia Carlos Natalia Bob Alice Yusuf Chen Ingrid Pablo Fatima Oskar".split()
CITIES = ["Paris", "New York", "Lima", "Berlin", "Oslo", "Buenos Aires", "Cairo", "Kyoto"]
UNITS = ["kilometres", "miles", "metres", "yards", "feet"]
MASSES = ["kilograms", "pounds", "ounces", "grams", "tonnes"]
VOLUMES = ["gallons", "litres", "pints", "cups", "millilitres"]
TIMES = ["minutes", "hours", "days", "weeks"]
QUESTIONS = [
    "{n} has {a} apples and buys {b} more at the market. {m} takes {c} of them home. How many apples does {n} have left?",
    "A train leaves {p} at {a}:15 and travels {b} {u} in {c} {t}. {n} waits in {q} for the train. What is its average speed?",
    "{n} pours {a} {v} of water into a tank that holds {b} {v}. {m} then removes {c} {v}. How much water is in the tank now?",
    "{p} is the city where {n} was born in {a}. After {b} {t} the family moved to {q}. In which city did {n} grow up?",
    "The weight of a box is {a} {w} and the weight of its lid is {b} {w}. {n} puts {c} boxes with lids on a cart. What does the cart carry in all?",
    "{n} and {m} share {a} sweets so that {n} gets {b} more than {m}. How many sweets does {m} get?",
    "On Monday {n} ran {a} {u} and on Tuesday {b} {u} more than that. {m} ran {c} {u} less on both days. How far did {m} run?",
    "Each of the {a} shelves holds {b} books. {n} borrows {c} books and {m} brings {d} books back. How many books are on the shelves at the end?",
    "{n} pays {a} dollars for a ticket to {p} and {b} dollars for one to {q}. {m} pays half of that. How much do they pay together?",
    "Water flows into a pool at {a} {v} per minute and out of it at {b} {v} per minute. {n} checks the pool after {c} {t}. How full is it?",
]
PROSE = "the river was calm and the farmers brought their hay to the old mill before the rain came down from the hills in the west of the county".split()


def values(r):
    n, m = r.sample(NAMES, 2)
    p, q = r.sample(CITIES, 2)
    a, b, c, d = r.sample(range(2, 900), 4)
    return dict(n=n, m=m, p=p, q=q, a=a, b=b, c=c, d=d, u=r.choice(UNITS), w=r.choice(MASSES), v=r.choice(VOLUMES), t=r.choice(TIMES))


def test_two_hundred_variants_and_clean_texts(spark):
    r = random.Random(11)
    items = [(i, q.format(**values(r))) for i, q in enumerate(QUESTIONS)]
    prose = lambda n: " ".join(r.choice(PROSE) for _ in range(n))
    texts, want = [], []
    for k in range(200):
        i = k % len(QUESTIONS)
        text = QUESTIONS[i].format(**values(r))
        if k % 7 == 3:
            text = text.replace(". ", ".\n")
        texts.append(f"{prose(r.randrange(40)).capitalize()}. {text} {prose(r.randrange(40))}." if k % 3 else text)
        want.append(i)
    clean = []
    for _ in range(100):  # the same vocabulary in sentences of other kinds, and prose with names and figures
        v = values(r)
        clean.append(r.choice([
            "{n} sold {a} apples in {p} last year and {b} pears. {m} moved to {q} with {c} books.",
            "{p} has {a} bridges, {b} of them over {c} metres long. {n} crossed them all in {d} {t}.",
            "{n}: {a}, {b}, {c}; {m}: {b}, {c}, {d}; {p}: {a} {u}, {q}: {b} {u}.",
            "How far is {p} from {q}? {n} says it is {a} {u}, {m} says {b} {u}.",
        ]).format(**v) + " " + prose(60))
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    got = {x["doc_id"]: x["item_ids"] for x in decontam.judged(docs, spark.createDataFrame(items, "item_id long, text string"), inside=True).collect()}
    hit = sum(w in got[k] for k, w in enumerate(want))
    assert hit >= 0.9 * len(want), (hit, [texts[k] for k, w in enumerate(want) if w not in got[k]][:3])
    assert [got[k] for k in range(len(want)) if set(got[k]) - {want[k]}] == []
    assert [clean[k] for k in range(100) if got[len(texts) + k]] == []


def test_case_diagonals_and_conflicts(spark):
    items = [(1, QUESTIONS[7].format(a=12, b=30, c=5, d=7, n="Anna", m="Peter")), (2, "1 2 3 4 5 6 7 8")]
    texts = [
        items[0][1].upper(), items[0][1].lower(),
        QUESTIONS[7].format(a=9, b=9, c=5, d=5, n="Julia", m="Bob"),  # different values become equal ones
        items[0][1].replace("Anna borrows", "Then one day, Julia borrows"),  # two diagonals
        items[0][1].replace("holds 30 books. Anna", "holds, as everyone here well knows, 31 books. Julia").replace("Peter", "Bob"),
        "numbers 11 12 13 14 15 16 17 18 19", "numbers 0 1 2 3 4 5 6 7 8 9",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["item_ids"] for x in decontam.judged(docs, spark.createDataFrame(items, "item_id long, text string"), inside=True).collect()}
    assert [got[k] for k in (0, 1, 2, 5, 6)] == [[1], [1], [1], [], [2]]
