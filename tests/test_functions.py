"""Goldens and derived edge cases of normalization, numbers and phonemes."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from vokaflow.functions import match, numbers, phonemes, text
from vokaflow.functions.normalize import normalize_text
from vokaflow.operators import manifest

WORDS = {
    0: "sıfır", 1: "bir", 9: "dokuz", 10: "on", 20: "yirmi", 99: "doksan dokuz", 100: "yüz", 200: "iki yüz", 999: "dokuz yüz doksan dokuz", 1000: "bin", 2000: "iki bin", 1923: "bin dokuz yüz yirmi üç",
    1000000: "bir milyon", 2500000: "iki milyon beş yüz bin", -5: "eksi beş", 1000000000000: "bir trilyon", 1001000000000000: "bin bir trilyon",
}
NORMALIZED = {
    "2.5": "iki.beş", "3,05": "üç virgül beş", "1.234,5": "bin iki yüz otuz dört virgül beş", "%1.000": "yüzde bir.sıfır", "%35,5": "yüzde otuz beş,beş", "3. kat": "üçüncü kat", "Saat 5.": "Saat beş.",
    "10.12.2024": "on.on iki.iki bin yirmi dört", "-5": "-beş", "007": "yedi", "A4": "A4", "5km": "5km", "5 km.": "beş kilometre.", "Dr.Ali": "doktorAli", "5 m²": "beş m²", "% 35": "yüzde otuz beş",
    "1.000.000": "bir milyon", "Prof.Dr. Ali": "profesörDr. Ali", "50 TL": "elli Türk lirası", "ATLAS": "ATLAS", "": "", "٣ x": "üç x", "<b>a</b> www.x.y @çağrı #etiket (b) “c” – d": 'a b "c" , d',
    "1000000000000000000000001": "bir trilyon trilyon bir", "é": "é", "şm m m": "şm metre metre", "a\x1cb  c": "a b c", "x.y@z.com son": "son",
}
PHONEMES = {"Işık": "i ʃ ɯ k", "dağ": "d a", "değer": "d e j e ɾ", "a b, 5": "a _ b ~ _ 5", "": "", "çcy": "tʃ dʒ j", "ğ": "", "a\nb": "a \n b"}


def one(spark, function, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(function("v")).collect()]


def test_number_words(spark):
    df = spark.createDataFrame([(n,) for n in WORDS], "n long")
    assert [r[0] for r in df.select(numbers.number_words("n")).collect()] == list(WORDS.values())


def test_ordinals(spark):
    want = {1: "birinci", 2: "ikiinci", 3: "üçüncü", 4: "dörtüncü", 6: "altııncı", 10: "onuncu", 1000: "bininci"}
    df = spark.createDataFrame([(n,) for n in want], "n long")
    assert [r[0] for r in df.select(numbers.ordinal_words("n")).collect()] == list(want.values())


def test_normalize_text(spark):
    assert one(spark, normalize_text, NORMALIZED) == list(NORMALIZED.values())


def test_no_number_is_left_between_boundaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bare = rf"{text.LEFT}\p{{Nd}}+{text.RIGHT}"
    assert docs.select(normalize_text("text").alias("t")).filter(F.col("t").rlike(bare)).count() == 0


def test_phonemize(spark):
    assert one(spark, phonemes.phonemize, PHONEMES) == list(PHONEMES.values())
    mapped = one(spark, phonemes.phonemize, list(phonemes.LETTERS))
    assert all(mapped[i] or letter == "ğ" for i, letter in enumerate(phonemes.LETTERS)) and len(phonemes.LETTERS) == 29


def test_ids(spark):
    df = spark.createDataFrame([(["a", "b", "dʒ", "ab", "", "X"],), ([],)], "p array<string>")
    got = df.select(phonemes.phoneme_ids("p"), phonemes.missing_phonemes("p")).collect()
    assert list(got[0]) == [[1, 0, 14, 0, 15, 0, 156, 0, 2], ["dʒ", "ab", ""]] and got[1][0] == [1, 0, 2]
    assert len(phonemes.ID_ORDER) == 159 and phonemes.ID_ORDER[154] == "g" and phonemes.ID_ORDER[130:140] == "0123456789"


def test_codepoints(spark):
    assert one(spark, phonemes.codepoints, ["aé🙂", ""]) == [[["a", "é", "🙂"]], [[]]]


@pytest.mark.parametrize("value", ["straße ΣΑΣ", "İI", "ÇŞĞÜÖI", ""])
def test_casefold(spark, value):
    assert one(spark, text.casefold, [value]) == [value.casefold()] == one(spark, text.casefold_exact, [value])


def test_stems(spark):
    want = {"a/b.wav": "b", "b": "b", ".hidden": ".hidden", "x/.h.wav": ".h", "a/b.tar.gz": "b.tar", "/a/b.c/": "b"}
    assert one(spark, text.file_stem, want) == list(want.values())


def test_terms(spark):
    assert match.parse_terms(" a, ,b ") == ["a", "b"]
    with pytest.raises(ValueError):
        match.parse_terms(" , ", required=True)
    assert match.repaired("çocuk".encode("cp1254").decode("utf-8", "surrogateescape")) == "çocuk"
    got = one(spark, lambda c: match.matched(c, ["öğrenci", "yok", "Çiçek"]), ["ÇİÇEK çiçek ÖĞRENCİ öğrenci", "x"])
    assert got == [["öğrenci", "Çiçek"], []]


def test_words_and_blanks(spark):
    values = ["  a b\x1fc ", "", "  ", "tek"]
    assert one(spark, text.word_count, values) == [len(v.split()) for v in values]
    assert one(spark, text.strip, values) == [v.strip() for v in values]
    assert one(spark, text.nfc, ["é", None]) == [unicodedata.normalize("NFC", "é"), None]


def test_abbreviations_at_once_equal_one_after_the_other(spark):
    order = sorted(text.ABBREVIATIONS, key=len, reverse=True)

    def one_by_one(t):
        for a in order:
            t = re.sub(rf"\b{re.escape(a)}" + (r"\b" if a[-1].isalpha() else ""), text.ABBREVIATIONS[a], t)
        return t

    rng = random.Random(9)
    parts = [*text.ABBREVIATIONS, "x", "5", "²", "_", " ", " ", ".", ",", "é", "Prof", "(", "doktor", text.FENCES[0]]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalize_abbreviations("t").alias("v")).collect()
    assert all(r["v"] == one_by_one(r["t"]) for r in got)


#: Word characters and blanks of all kinds, those above U+FFFF too, between numbers, and numbers in chains.
NUMBER_PARTS = ["1", "05", "12", "456", "1.000", "2.345.678", "1.234,5", "1,2", "1,2,3,4,5", "%", " ", " ", "\t", "\n", "\x0b", "\x85", " ", ".", ",", "-", "a", "_", "²", "Ⅷ", "ª", "é", "é", "一", "٣", "٠١", "𝟎", "𐐀", "𝐀", "𝍠", "😀", "\\1", "$1"]
GLUED = {"𐐀5": "𐐀5", "𐐀5 5": "𐐀5 beş", "𝐀1.234": "𝐀1.iki yüz otuz dört", "𝐀1,5": "𝐀1,beş", "𐐀3. x": "𐐀3. x", "😀5": "😀beş", "5𐐀": "5𐐀"}


def _spoken(n: int) -> str:
    if n == 0:
        return numbers.ZERO
    for size, name in ((10**12, numbers.TRILLION), (10**9, numbers.BILLION), (10**6, numbers.MILLION), (1000, numbers.THOUSAND), (100, numbers.HUNDRED)):
        if n >= size:
            head = name if n // size == 1 and size <= 1000 else f"{_spoken(n // size)} {name}"
            return f"{head} {_spoken(n % size)}" if n % size else head
    return f"{numbers.TENS[n // 10]} {numbers.ONES[n % 10]}".strip()


def _read_one_after_the_other(t: str) -> str:
    whole = lambda m: _spoken(int(m[0].replace(".", "")))
    decimal = lambda m: f"{_spoken(int(m[1].replace('.', '')))} {numbers.COMMA} {_spoken(int(m[2]))}"

    def ordinal(m):
        words = _spoken(int(m[1]))
        return words + numbers.ORDINAL[re.findall("[aıeioöuü]", words)[-1]]

    t = re.sub(r"%\s*(\d+)", lambda m: f"{numbers.PERCENT} {_spoken(int(m[1]))}", t)
    for pattern, words in ((r"\b(\d{1,3}(?:\.\d{3})+),(\d+)\b", decimal), (r"\b\d{1,3}(?:\.\d{3})+\b", whole), (r"\b(\d+),(\d+)\b", decimal), (r"\b(\d+)\.(?=[ \t])", ordinal), (r"\b\d+\b", whole)):
        t = re.sub(pattern, words, t)
    return t


def test_numbers_glued_to_characters_above_the_first_plane(spark):
    assert one(spark, numbers.normalize_numbers, GLUED) == list(GLUED.values()) == [_read_one_after_the_other(t) for t in GLUED]


def test_numbers_equal_the_rules_one_after_the_other(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(NUMBER_PARTS) for _ in range(rng.randrange(1, 10))) for _ in range(4000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", numbers.normalize_numbers("t").alias("v")).collect()
    bad = [(r["t"], r["v"], w) for r in got if r["v"] != (w := _read_one_after_the_other(r["t"]))]
    assert not bad, bad[:5]


def test_whole_texts_keep_what_is_glued_to_characters_above_the_first_plane(spark):
    assert one(spark, normalize_text, GLUED) == list(GLUED.values())


def test_abbreviations_glued_to_characters_above_the_first_plane(spark):
    assert one(spark, text.normalize_abbreviations, ["𐐀km", "𝐀Dr.x", "😀km"]) == ["𐐀km", "𝐀Dr.x", "😀kilometre"]


def test_manifest_keeps_numbers_glued_to_characters_above_the_first_plane(spark):
    raw = spark.createDataFrame([("a.wav", " 𐐀5 km ", 1.0, "s")], "audio_filepath string, text string, duration double, speaker_id string")
    assert [r["normalized_text"] for r in manifest.prepare_manifest(raw).collect()] == ["𐐀5 kilometre"]
