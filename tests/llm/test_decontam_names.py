from .test_decontam_items import judge

ITEMS = [
    (1, "Natalia sold 48 clips in April. Natalia then sold half as many clips in May. How many clips did she sell?"),
    (2, "Alice has 5 apples. Bob has 7 apples. How many apples do they have in total?"),
    (3, "On the way to the old mill the farmer met Doctor Brown and asked him about the price of hay in June"),
]


def test_names_that_open_sentences_and_other_space_and_case(spark):
    n, a, m = (x for _, x in ITEMS)
    texts = [
        n.replace("Natalia", "Robert").replace("48", "60"), "Well. " + n.replace("Natalia", "Robert").replace("48", "60").replace(". ", ".\n"),
        a.replace("Alice", "Carol").replace("5", "3").replace("Bob", "Dan").replace("7", "9"),
        m.replace("met Doctor Brown", "met\nDoctor  Brown").replace("in June", "in  June"), "so " + m.lower(),
        a.replace("Alice", "Carol").replace("apples", "pears").replace("total", "sum"), "Robert sold 60 houses in May. Eve then left.",
    ]
    assert judge(spark, texts, ITEMS) == {0: [1], 1: [1], 2: [2], 3: [3], 4: [3], 5: [], 6: []}
