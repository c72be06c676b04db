"""Benchmark decontamination by template canonicalisation: exact and re-parameterised benchmark items in documents.

Names, numbers and units become typed placeholders, the rest lower-case words; windows of five template tokens of all
items are hash-joined with those of all documents. A window of placeholders alone is told by its values, so tables of
figures are no hot key. Matches on one diagonal (same shift between document and item) are kept if their slots agree:
each value of the item stands for one value of the document, the one that most windows say; windows that say another
go. What other diagonals add must not contradict the best one.
An item is found in a document if at least 0.8 of its windows match so, under one of two readings of both: without
names, whatever the case; or with every capitalised word a name, wherever it stands, that is neither a function word of
English, German, French or Spanish nor, after a German article, a noun.
Items of fewer than five tokens are one window, read without names, which is found in texts of the same tokens or, if
asked for, inside longer ones.

Only DataFrame functions run. The items' windows are broadcast after their number is checked, else joined by shuffle.
Defined cases: null and empty texts match nothing; a text of any length is read as a whole; repeated rows are judged
alike, each with its own row; equal items count each; of values that as many windows say the largest stands; no items,
or no documents, give no match, or no rows; other columns play no part and may be kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, SHARE = 5, 0.8
#: Windows of items that may be sent to all tasks (some 50 bytes each).
BROADCAST_WINDOWS = 500_000
# Fixed values of four languages: number words, unit words, and words that are no names where they open a sentence. Words
# that mean something else in another of the languages (French six counts, Spanish once and French cent do not) are left out.
NUMBER_WORDS = tuple(
    (
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
        "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
        "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn zwanzig dreißig vierzig fünfzig hundert tausend "
        "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante mille "
        "cero dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce veinte treinta cuarenta cincuenta sesenta cien"
    ).split()
)
_SHORT_UNITS = "kg g mg lb lbs oz km m cm mm mi ft yd l ml cl dl s sec secs min mins h hr hrs kmh kph mph kw kwh mw w v a hz khz mhz ghz kb mb gb tb usd eur gbp"
_PLAIN_UNITS = "foot feet inch inches yard mile acre hectare ounce pound stone gallon quart pint cup tablespoon teaspoon dozen minute hour day night week month year decade century centuries dollar cent euro penny pence pennies yen rupee franc peso mark percent degree knot barrel bushel"
_METRIC_UNITS = "gram gramme meter metre liter litre watt volt amp hertz byte bit joule newton calorie second tonne ton gramm mètre gramo metro litro"
_OTHER_UNITS = "stunde stunden minuten tag tage tagen woche wochen monat monate monaten jahr jahre jahren sekunde sekunden pfund grad prozent heure jour semaine mois ans année seconde livre degré hora minuto día mes meses semana año segundo libra grado kilómetro"
_PREFIXES = ("", "kilo", "centi", "milli", "mega", "giga", "tera", "micro", "nano", "deci")
FUNCTION_WORDS = {
    "en": (
        "A An The This That These Those It Its He His Him She Her They Their Them We Our Us You Your I My And Or But If Then So As At By For From In Into "
        "Of On To With Without About After Before During While Until Since Because Although When Where Which Who Whom Whose What Why How Is Are Was Were Be "
        "Do Does Did Has Have Had Can Could Will Would Should May Might Must Not No Yes Each Every All Some Any Many Much More Most Both Between Over Under "
        "There Here Now Later First Next Finally Today Yesterday Tomorrow Suppose Given Let Calculate Find"
    ),
    "de": (
        "Der Die Das Den Dem Des Ein Eine Einen Einem Einer Eines Er Sie Es Wir Ihr Sein Seine Ihre Mein Meine Kein Keine Dieser Diese Dieses Und Oder Aber "
        "Wenn Dann Weil Da Als Ob Wie Wo Wer Wen Wem Was Wann Warum Welche Welcher Welches Wieviel Wieviele Auf Aus Bei Bis Durch Für Gegen Mit Nach Ohne "
        "Seit Um Unter Von Vor Zu Zum Zur Am Im Vom Beim Nicht Nun Jetzt Hier Dort Heute Morgen Gestern Jeder Jede Jedes Alle Viele Ist Sind War Waren Hat Haben Kann"
    ),
    "fr": (
        "Le La Les Un Une Des Du De Au Aux Ce Cet Cette Ces Il Elle Ils Elles Nous Vous Je Tu On Son Sa Ses Leur Leurs Mon Ma Mes Et Ou Mais Si Alors Donc "
        "Car Quand Comme Que Qui Quoi Quel Quelle Quels Quelles Combien Comment Pourquoi Où Dans Sur Sous Avec Sans Pour Par Après Avant Pendant Depuis Chez "
        "Entre Chaque Tous Toutes Est Sont Ne Pas Ici Maintenant Puis Ensuite"
    ),
    "es": (
        "El Los Las Una Unos Unas Al Del Este Esta Estos Estas Ese Esa Él Ella Ellos Ellas Nosotros Yo Su Sus Mi Mis Y O Pero Entonces Porque Cuando Como Que "
        "Quien Cuál Cuánto Cuánta Cuántos Cuántas Cómo Dónde Qué Quién En Con Sin Para Por Sobre Desde Hasta Entre Cada Todos Todas Es Son No Sí Aquí Ahora Luego Después"
    ),
}
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
#: Scripts without spaces between words: each letter is a token.
_SCRIPTS = r"\u0e00-\u0e7f\u3005\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\x{20000}-\x{323af}"
_OPENERS = "|".join(sorted({w for words in FUNCTION_WORDS.values() for w in words.split()}))
#: What stands before a German noun, which is written like a name: an article or the like, in any of its forms.
_ARTICLES = "d(?:er|ie|as|en|em|es)|[kmds]?eine?[nmrs]?|(?:ihr|unser|euer|eur)(?:e[nmrs]?)?|(?:dies|jed|jen|welch|manch|solch|all)e[nmrs]?|[ai]m|zu[mr]|vom|beim|ans|ins"
#: A name wherever it stands, sentence openers too: no function word begins one, and after a German article, be there a
#: word in small letters between or not, it is a noun.
_ANY_NAMES = (
    rf"(?=\p{{Lu}})(?<!\p{{L}})(?<!(?<!\p{{L}})(?i:{_ARTICLES}) (?:\p{{Ll}}{{1,20}} )?)"
    rf"((?!(?:{_OPENERS})(?!\p{{L}}))\p{{Lu}}\p{{L}}*(?: \p{{Lu}}\p{{L}}*)*+)"
)
# Repeated groups are possessive: nothing comes after them to go back for, and a greedy one takes stack for each word of a run.
_NUMBERS = r"\p{N}+(?:[.,:]\p{N}+)*+"
#: Readings of a text: without names; with names.
PLAIN, NAMED = 0, 1


def units() -> tuple[str, ...]:
    """Unit words of four languages in the singular and the plural, metric ones with their prefixes."""
    metric = [p + u for u in _METRIC_UNITS.split() for p in _PREFIXES]
    words = [*_PLAIN_UNITS.split(), *_OTHER_UNITS.split(), *metric]
    return tuple(sorted({*_SHORT_UNITS.split(), *words, *(w + "s" for w in words)}))


#: White space that is no single space, and marks.
_SPACE = " ?[\x01-\x04\t-\r][\x01-\x04\\s]*| {2,}"
#: A slot, a word, or a letter of the scripts without spaces. The commonest letters are tried first.
_TOKENS = f"([\x01-\x03][^\x04]*\x04|[a-zß-öø-ÿ[\\p{{L}}&&[^{_SCRIPTS}]]]+|\\p{{L}})"


def marked(text: Column, reading: int = NAMED) -> Column:
    """The text in lower case with a mark and its value for each name, number and unit sign: mark, value, mark."""
    if reading == PLAIN:
        out = F.regexp_replace(F.lower(text), "[\x01-\x04]", " ")
    else:
        out = F.lower(F.regexp_replace(F.regexp_replace(text, _SPACE, " "), _ANY_NAMES, f"{NAME}$1\x04"))
    out = F.regexp_replace(out, _NUMBERS, f" {NUMBER}$0\x04 ")
    return F.regexp_replace(out, r"\x04 {0,2}([%$€£°])", f"\x04 {UNIT}$1\x04 ")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def raw_tokens(text: Column, reading: int = NAMED) -> Column:
    """Tokens in lower case; a slot is its mark followed by its value. Number words are numbers; a unit follows a number."""
    found = F.regexp_extract_all(marked(text, reading), F.lit(_TOKENS), F.lit(1))
    names = units()

    def typed(x: Column, before: Column) -> Column:
        number = x.isin(*NUMBER_WORDS)
        unit = (before.startswith(NUMBER) | before.isin(*NUMBER_WORDS)) & x.isin(*names)
        return F.when(number, F.concat(F.lit(NUMBER), x, F.lit("\x04"))).when(unit, F.concat(F.lit(UNIT), x, F.lit("\x04"))).otherwise(x)

    return _let(found, lambda t: F.zip_with(t, F.slice(F.concat(F.array(F.lit("")), t), F.lit(1), F.size(t)), typed))


def _is_slot(token: Column) -> Column:
    return token < F.lit("\x04")


def windows(rows: DataFrame, keys: list[str], size: int = WINDOW, short: tuple[int, ...] = ()) -> DataFrame:
    """Rows with text, or tokens -> (keys, pos, w, t0..): each window of `size` tokens, or one for a shorter text; w hashes
    its template, or its values if it has slots only. For every length of `short` also each window of so many tokens,
    the others null."""
    t = F.col("tokens")
    shifted = [F.slice(t, F.lit(i + 1), F.greatest(F.size(t) - size + 1, F.lit(1))).alias(f"t{i}") for i in range(size)]
    split = rows if "tokens" in rows.columns else rows.select(*keys, raw_tokens(F.col("text")).alias("tokens"))
    split = split.filter(F.size(t) > 0)
    made = split.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "z")).select(*keys, "pos", "z.*")
    if short:
        split = split.select(*keys, t, F.explode(F.array(*(F.lit(n) for n in short))).alias("_n")).filter(F.size(t) > F.col("_n"))
        heads = split.select(*keys, t, "_n", F.posexplode(F.slice(t, F.lit(1), F.size(t) - F.col("_n") + 1)).alias("pos", "t0"))
        made = made.unionByName(heads.select(*keys, "pos", "t0", *(F.when(F.col("_n") > i, F.get(t, F.col("pos") + i)).alias(f"t{i}") for i in range(1, size))))
    parts = [F.when(_is_slot(F.col(f"t{i}")), F.substring(f"t{i}", 1, 1)).otherwise(F.col(f"t{i}")) for i in range(size)]
    slots = F.coalesce(F.least(*(_is_slot(F.col(f"t{i}")) for i in range(size))) & F.col(f"t{size - 1}").isNotNull(), F.lit(False))
    return made.withColumn("w", F.when(slots, F.xxhash64(*(F.col(f"t{i}") for i in range(size)))).otherwise(F.xxhash64(*parts)))


def _readings(text: Column) -> Column:
    return F.array(raw_tokens(text, PLAIN), raw_tokens(text, NAMED))


def item_windows(items: DataFrame) -> DataFrame:
    """The windows of each item under its readings; w differs by the reading."""
    own = items.select(F.col("item_id").cast("bigint").alias("item_id"), common.text_of().alias("text"))
    own = own.withColumn("item_key", F.xxhash64("text", F.coalesce("item_id", F.lit(-1)))).dropDuplicates(["item_id", "item_key"])
    read = own.select("item_id", "item_key", F.posexplode(_readings(F.col("text"))).alias("reading", "tokens")).withColumn("n_tokens", F.size("tokens"))
    read = read.filter((F.col("reading") == PLAIN) | (F.col("n_tokens") >= WINDOW))
    w = windows(read, ["item_id", "item_key", "reading", "n_tokens"])
    return w.select("item_id", "item_key", "reading", "n_tokens", F.col("pos").alias("item_pos"), F.col("w").bitwiseXOR(F.col("reading")).alias("w"), *(F.col(f"t{i}").alias(f"i{i}") for i in range(WINDOW)))


def _stands_for(pairs: Column) -> Column:
    """For each value i of an item the value t that most pairs give it, the largest at ties."""

    def most(f: Column, i: Column) -> Column:
        said = F.transform(F.filter(f, lambda p: p["i"] == i), lambda p: p["t"])
        return _let(said, lambda all_: F.array_max(F.transform(F.array_distinct(all_), lambda t: F.struct(F.size(F.filter(all_, lambda x: x == t)).alias("n"), t.alias("t")))))["t"]

    return _let(pairs, lambda f: F.transform(F.array_distinct(F.transform(f, lambda p: p["i"])), lambda i: F.struct(i.alias("i"), most(f, i).alias("t"))))


def found(docs: DataFrame, items: DataFrame, share: float = SHARE, inside: bool = False) -> DataFrame:
    """(text_key, item_id, matched, n_windows) for each item found in a text; text_key is the text's 64-bit hash. The
    numbers are those of the reading without names if that finds the item.

    With `inside`, items of fewer than five tokens are also found inside longer texts; if they have slots only, with
    the same values. Equal texts are one: their matches collapse before the shuffle."""
    wanted, _ = common.written(item_windows(items), "item-windows")
    few = wanted.count() <= BROADCAST_WINDOWS
    hint = F.broadcast if few else lambda x: x
    sizes = wanted.groupBy("item_key", "reading").agg(F.countDistinct("item_pos").alias("n_windows"))
    short = tuple(r[0] for r in wanted.filter(F.col("n_tokens") < WINDOW).select("n_tokens").distinct().collect()) if inside else ()
    own = docs.select(common.text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    own = own.select("text_key", F.posexplode(_readings(F.col("text"))).alias("of_text", "tokens")).withColumn("n", F.size("tokens"))
    made = windows(own, ["text_key", "of_text", "n"], short=short)
    hits = made.withColumn("w", F.col("w").bitwiseXOR(F.col("of_text"))).join(hint(wanted), "w")
    if short:
        words = [F.coalesce(~_is_slot(F.col(f"i{i}")), F.lit(False)) | F.col(f"i{i}").eqNullSafe(F.col(f"t{i}")) for i in range(WINDOW)]
        some = [F.coalesce(~_is_slot(F.col(f"i{i}")), F.lit(False)) for i in range(WINDOW)]
        hits = hits.filter((F.col("n_tokens") >= WINDOW) | (F.col("n") == F.col("n_tokens")) | F.greatest(*some) | F.least(*words))
    pairs = F.array(*(F.when(_is_slot(F.col(f"i{i}")), F.struct(F.col(f"i{i}").alias("i"), F.col(f"t{i}").alias("t"))) for i in range(WINDOW)))
    of = ["text_key", "item_id", "item_key", "reading"]
    hits = hits.select(*of, (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos", F.filter(pairs, lambda p: p.isNotNull()).alias("pairs")).distinct()
    hits, _ = common.written(hits, "template-hits")
    by = ["text_key", "item_key", "reading"]  # item_key tells null ids too
    cover = hits.groupBy(*by).agg(F.size(F.collect_set("item_pos")).alias("covered")).join(hint(sizes), ["item_key", "reading"])
    cover = cover.withColumn("need", F.ceil(F.lit(share) * F.col("n_windows"))).filter("covered >= need").select(*by, "n_windows", "need")
    hits = hits.join(cover, by)
    of += ["n_windows", "need"]
    lines = hits.groupBy(*of, "shift").agg(F.collect_list(F.struct("item_pos", "pairs")).alias("ws"))
    lines = lines.withColumn("m", _stands_for(F.flatten(F.transform("ws", lambda w: w["pairs"]))))
    agree = _let(F.col("m"), lambda m: F.filter("ws", lambda w: F.forall(w["pairs"], lambda p: F.exists(m, lambda q: (q["i"] == p["i"]) & (q["t"] == p["t"])))))
    lines = lines.select(*of, "shift", "m", agree.alias("ws"))
    whole = lines.groupBy(*of).agg(F.max_by("m", F.struct(F.size("ws"), -F.col("shift"))).alias("m"), F.flatten(F.collect_list("ws")).alias("ws"))
    left = _let(F.col("m"), lambda m: F.filter("ws", lambda w: ~F.exists(w["pairs"], lambda p: F.exists(m, lambda q: (q["i"] == p["i"]) & (q["t"] != p["t"])))))
    enough = whole.withColumn("matched", F.size(F.array_distinct(F.transform(left, lambda w: w["item_pos"])))).filter("matched >= need")
    best = enough.groupBy("text_key", "item_id", "item_key").agg(F.min_by(F.struct("matched", "n_windows"), "reading").alias("b"))
    return best.select("text_key", "item_id", "b.matched", "b.n_windows")


def judged(docs: DataFrame, items: DataFrame, share: float = SHARE, keep: tuple[str, ...] = ("doc_id",), inside: bool = False) -> DataFrame:
    """The kept columns, contaminated, item_ids (ascending, nulls first) and the largest share of an item's windows found."""
    hits = found(docs, items, share, inside).groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("item_id"))).alias("item_ids"), F.max(F.col("matched") / F.col("n_windows")).alias("share"))
    hits, _ = common.written(hits, "contaminated")
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.xxhash64(common.text_of()).alias("text_key")).join(hits, "text_key", "left")
    ids = F.coalesce(F.transform("item_ids", lambda x: x["item_id"]), F.array().cast("array<bigint>"))
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), F.col("share").isNotNull().alias("contaminated"), ids.alias("item_ids"), F.coalesce("share", F.lit(0.0)).alias("share"))


def without(docs: DataFrame, items: DataFrame, share: float = SHARE, inside: bool = False) -> DataFrame:
    """The documents in which no item was found, all columns kept."""
    hits, _ = common.written(found(docs, items, share, inside).select("text_key").distinct(), "contaminated")
    own = common.Shielded(docs)
    rows = own.inner.withColumn("_text_key", F.xxhash64(common.text_of(own("text"))))
    return own.restore(rows.join(hits.withColumnRenamed("text_key", "_text_key"), "_text_key", "left_anti"))
