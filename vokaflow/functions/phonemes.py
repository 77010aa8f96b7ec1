"""Rule-based Turkish phonemes and phoneme ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import normalize_text

#: Letters whose phoneme is another one; all other letters are their own. A soft g
#: is j after a front vowel and silent elsewhere.
PHONEMES = {"ı": "ɯ", "ö": "ø", "ü": "y", "c": "dʒ", "ç": "tʃ", "j": "ʒ", "r": "ɾ", "ş": "ʃ", "y": "j"}
LETTERS = "abcçdefgğhıijklmnoöprsştuüvyz"
VOWELS, FRONT_VOWELS, SOFT_G = "aeıioöuü", "eiöü", "ğ"
CONSONANTS = "".join(x for x in LETTERS if x not in VOWELS)
PAUSES, SPACE_SYMBOL, PAUSE_SYMBOL = ".,!?;:-", "_", "~"
#: The phonemes with ids, in the order of their ids from 0 on.
ID_ORDER = (
    "_^$ !'(),-.:;?abcdefhijklmnopqrstuvwxyzæçðøħŋœǀǁǂǃɐɑɒɓɔɕɖɗɘəɚɛɜɞɟɠɡɢɣɤɥɦɧɨɪɫɬɭɮɯɰɱɲɳɴɵɶɸɹɺɻɽɾʀʁʂʃʄʈʉʊʋʌʍʎʏʐʑʒʔʕʘʙʛʜʝʟʡʢʲˈˌːˑ˞βθχᵻⱱ0123456789"
    "̧̪̯̩̃ʰˤε↓#\"↑̺̻gʦX̝̊"
)
PAD, BOS, EOS, MOST_SYMBOLS = 0, 1, 2, 256


def phonemize(c: Column | str) -> Column:
    """Phonemes of normalized text, one space apart.

    Lower case is the general one, not the Turkish one. A space is ``_``, punctuation ``~``, and
    anything unknown stays. Only string functions: each character gets a space, then all are translated at once.
    """
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    text = F.replace(F.regexp_replace(text, f"(?<=[{FRONT_VOWELS}]){SOFT_G}", "y"), F.lit(SOFT_G), F.lit(""))
    text = F.translate(text, " " + PAUSES, SPACE_SYMBOL + PAUSE_SYMBOL * len(PAUSES))
    spaced = F.regexp_replace(text, "(?s)(.)", "$1 ")
    single = {k: v for k, v in PHONEMES.items() if len(v) == 1}
    out = F.translate(spaced, "".join(single), "".join(single.values()))
    for letter in (k for k in PHONEMES if k not in single):
        out = F.replace(out, F.lit(letter), F.lit(PHONEMES[letter]))
    return F.regexp_replace(out, " $", "")


def codepoints(c: Column | str) -> Column:
    """One sentence of one-character phonemes; an empty text gives an empty sentence."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array(F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, "")))


def phoneme_id(p: Column) -> Column:
    """A phoneme's id, or null. Ids are places in one string, so there is no map to search."""
    at = F.call_function("position", p, F.lit(ID_ORDER))
    return F.when((F.length(p) == 1) & (at > 0), at - 1)


def phoneme_ids(phonemes: Column | str) -> Column:
    """Start, padding, then each known phoneme and padding, then end. Unknown ones are skipped."""
    phonemes = F.col(phonemes) if isinstance(phonemes, str) else phonemes
    known = F.filter(F.transform(phonemes, phoneme_id), lambda i: i.isNotNull())
    padded = F.flatten(F.transform(known, lambda i: F.array(i, F.lit(PAD))))
    return F.concat(F.array(F.lit(BOS), F.lit(PAD)), padded, F.array(F.lit(EOS)))


def missing_phonemes(phonemes: Column | str) -> Column:
    """The phonemes without an id, repeats kept."""
    return F.filter(F.col(phonemes) if isinstance(phonemes, str) else phonemes, lambda p: phoneme_id(p).isNull())


def text_to_phonemes(c: Column | str) -> Column:
    """normalize_text, then phonemize."""
    return phonemize(normalize_text(c))
