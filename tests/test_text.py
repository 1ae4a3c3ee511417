"""Text and array functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from larkspur.functions import arrays as ar
from larkspur.functions import text as tx


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first()["r"]


def test_gap_tokens_are_long_lower_case_pieces(spark):
    assert one(spark, "Fast Food, été couper LeCafé abcd ab", tx.gap_tokens) == ["fast", "food", "couper", "lecaf", "abcd"]
    assert one(spark, "", tx.gap_tokens) == []
    assert one(spark, None, tx.gap_tokens) is None


def test_stop_words_go_and_repeats_stay(spark):
    assert one(spark, "this food that food", lambda c: tx.remove_words(tx.gap_tokens(c))) == ["food", "food"]
    from pyspark.ml.feature import StopWordsRemover

    assert list(tx.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_word_tokens_keep_accents(spark):
    assert one(spark, "Été a_b c 12 d3!", tx.word_tokens) == ["été", "a_b", "12", "d3"]


def test_accents(spark):
    assert one(spark, "Éçà über ñandú Šk", tx.strip_accents) == "Eca uber nandu Sk"


def test_phrase_count_takes_whole_words_literally(spark):
    text = "Thai, Thai Thailand (Thai) éThai C++ C++x"
    assert one(spark, text, lambda c: tx.phrase_count(c, F.lit("Thai"))) == 3
    assert one(spark, text, lambda c: tx.phrase_count(c, F.lit("C++"))) == 1
    assert one(spark, "Fast Food Fast Food", lambda c: tx.phrase_count(c, F.lit("Fast Food"))) == 2


def test_labels(spark):
    parts = lambda c: tx.keep_listed(tx.split_trim(c), ["Thai", "Pizza"], default="other")
    assert one(spark, "Bars,  Pizza , Thai", parts) == "Pizza,Thai"
    assert one(spark, "Bars", parts) == "other"
    assert one(spark, "Bars", lambda c: tx.keep_listed(tx.split_trim(c), ["Thai"])) == ""


def test_sentences_are_marked_and_cut_again(spark):
    text = "Cut 2 red Apples. Mix! 34 .. Don't  stop"
    tokens = one(spark, text, tx.sentence_tokens)
    start = tx.MARKER
    assert tokens == [start, "cut", "red", "apples", ".", start, "mix", ".", start, ".", start, "dont", "stop", "."]
    cut = one(spark, tokens, tx.token_sentences, "array<string>")
    assert cut == [["cut", "red", "apples", "."], ["mix", "."], ["."], ["dont", "stop", "."]]
    assert one(spark, [start, start, "a", start], tx.token_sentences, "array<string>") == [["a"]]
    assert one(spark, [], tx.token_sentences, "array<string>") == []
    assert one(spark, ["a", start, "sentence_startx"], tx.token_sentences, "array<string>") == [["a"], ["sentence_startx"]]


def test_padding(spark):
    assert one(spark, ["a"], lambda c: tx.pad(c, 3, "P"), "array<string>") == ["a", "P", "P"]
    assert one(spark, [1, 2, 3, 4], lambda c: tx.pad(c, 3, 0), "array<int>") == [1, 2, 3]


def test_word_selection(spark):
    words = ["station", "great", "friendly", "food", "visible", "thing"]
    pick = lambda kind: one(spark, words, lambda c: tx.select_words(c, kind), "array<string>")
    assert pick("noun") == ["station", "food", "thing"]
    assert pick("adjective") == ["great", "friendly", "visible"]
    assert pick("noun_adjective") == words
    assert one(spark, [], lambda c: tx.select_words(c, "noun"), "array<string>") == ["na"]
    assert one(spark, [], lambda c: tx.select_words(c, "noun", None), "array<string>") == []
    assert one(spark, ["zzz"], lambda c: tx.select_words(c, "noun"), "array<string>") == []


def test_polarity(spark):
    words = ["worst", "great", "chair", "unseen", "visible"]
    assert one(spark, words, tx.polarity_histogram, "array<string>") == [1, 1, 1, 1, 1, 2.0]
    assert one(spark, ["great"], tx.document_polarity, "array<string>") == 4
    assert one(spark, [], tx.document_polarity, "array<string>") == -1
    assert one(spark, [], tx.polarity_histogram, "array<string>")[5] == -1


def test_lexicon_modes(spark):
    assert one(spark, "price", lambda c: tx.has_entry(c, ["rice", " "])) is True
    assert one(spark, "price", lambda c: tx.has_entry(c, ["rice"], "exact")) is False
    assert one(spark, "price", lambda c: tx.has_entry(c, ["", " "])) is False


def test_arrays(spark):
    assert one(spark, [-1, 0, 1, None], ar.negatives_to_zero, "array<int>") == [0, 0, 1, None]
    assert one(spark, 2, lambda c: ar.one_hot(c, 3), "int") == [0, 1, 0]
    top = one(spark, [0.1, 0.9, 0.9, 0.5], lambda c: ar.top_scores(c, 3), "array<double>")
    assert [(p["score"], p["idx"]) for p in top] == [(0.9, 1), (0.9, 2), (0.5, 3)]
    assert one(spark, [0.5, 0.49], ar.at_least, "array<double>") == [1, 0]


def test_reference_arrays_must_be_complete(spark):
    full = spark.createDataFrame([(1, 20), (0, 10)], "i int, v int")
    assert ar.positional_array(full, "i", "v", 2).first()["reference"] == [10, 20]
    with pytest.raises(Exception, match="expected 3 reference values"):
        ar.positional_array(full, "i", "v", 3).collect()


def test_label_vocabulary_has_a_checked_size(spark):
    df = spark.createDataFrame([(["b", "a"],), (["c", "a"],)], "l array<string>")
    assert ar.label_vocabulary(df, "l").first()["vocabulary"] == ["a", "b", "c"]
    with pytest.raises(Exception, match="more than 2 labels"):
        ar.label_vocabulary(df, "l", limit=2).collect()


def test_word_rules_can_be_replaced(spark):
    rules = tx.WordRules(noun_words=("kapu",), noun_suffixes=(), polarity_words={4: ("jo",)}, polarity_prefixes={}, polarity_suffixes={})
    assert one(spark, "kapu food jo", lambda c: tx.select_words(F.split(c, " "), "noun", rules=rules)) == ["kapu"]
    assert one(spark, "kapu food jo", lambda c: tx.polarity_histogram(F.split(c, " "), rules)) == [0, 0, 2, 0, 1, 8 / 3]
