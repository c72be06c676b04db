"""Re-parameterised questions in German, French and Spanish, and texts that share nothing but their build."""

import pytest

from .test_decontam_items import judge

ITEMS = [
    (1, "Die Katze schläft auf dem Sofa und träumt von einer Maus am Abend, bis der Regen kommt"),
    (2, "Anna hat 12 Äpfel und kauft drei weitere. Peter nimmt 4 davon nach Hause. Wie viele hat Anna am Ende in dem Korb?"),
    (3, "Marie parcourt 40 kilomètres en deux heures. Ensuite Paul parcourt 15 kilomètres de plus. Combien de temps met Paul ?"),
    (4, "María compra 8 panes y cinco quesos. Luego Pedro vende 3 panes a su vecino. Cuántos panes tiene María al final del día?"),
]
CASES = {
    "german nouns are no names": ("Die Firma schläft auf dem Markt und träumt von einer Fusion am Montag, bis der Käufer kommt", []),
    "nouns after adjectives": ("Die Katze schläft auf dem alten Sofa und träumt von einer kleinen Maus am Abend, bis der Regen kommt", []),
    "the same german text": (ITEMS[0][1], [1]),
    "german": ("Sofia hat 31 Äpfel und kauft sieben weitere. Oskar nimmt 9 davon nach Hause. Wie viele hat Sofia am Ende in dem Korb?", [2]),
    "german, other nouns": ("Sofia hat 31 Hunde und sucht sieben weitere. Oskar nimmt 9 davon in die Schule. Wer sieht Sofia am Montag in dem Haus?", []),
    "french": ("Louise parcourt 70 mètres en trois minutes. Ensuite Hugo parcourt 25 mètres de plus. Combien de temps met Hugo ?", [3]),
    "spanish": ("Lucía compra 14 panes y seis quesos. Luego Carlos vende 9 panes a su vecino. Cuántos panes tiene Lucía al final del día?", [4]),
}


@pytest.fixture(scope="module")
def judged(spark):
    return judge(spark, [t for t, _ in CASES.values()], ITEMS)


@pytest.mark.parametrize("case", CASES)
def test_language(judged, case):
    assert judged[list(CASES).index(case)] == CASES[case][1]
