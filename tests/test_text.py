import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from postlytics.functions import text as X
from postlytics.functions.stopwords import SPARK_ENGLISH, STOP_WORDS

TEXTS = [
    "RT @a: Don't  go #MAGA",
    "",
    "   ",
    " leading and trailing \t\n",
    "tab\tnew\nline\x0bvertical\fform\rreturn",
    "\U0001f600 \U0001f1fa\U0001f1f8",
    "Überall é naïve 123 4-5_6",
    "a b c THE The rt RT",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column.alias("x")).collect()]


def test_tokenize_equals_ml_tokenizer(texts):
    expected = Tokenizer(inputCol="text", outputCol="t").transform(texts)
    assert values(texts, X.tokenize(F.col("text"))) == values(expected, F.col("t"))


def test_clean_words_by_hand(texts):
    cleaned = values(texts, X.clean_words(F.col("text")))
    assert cleaned[0] == ["dont", "go", "maga"]
    assert cleaned[1] == cleaned[2] == cleaned[5] == []
    assert cleaned[4] == ["tab", "new", "line", "vertical", "form", "return"]
    assert cleaned[6] == ["berall", "nave", "123", "456"]
    assert cleaned[7] == ["b", "c"]


def test_one_pass_equals_the_separate_steps(texts):
    steps = X.strip_tokens(X.tokenize(F.col("text")))
    assert values(texts, X.plain_words(F.col("text"))) == values(texts, steps)
    removed = X.remove_stop_words(steps)
    assert values(texts, X.clean_words(F.col("text"))) == values(texts, removed)


def test_stripped_ranges_equal_the_negated_class(spark):
    points = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    chars = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "id int, text string")
    steps = X.strip_tokens(X.tokenize(F.col("text")))
    different = chars.filter(X.plain_words(F.col("text")) != steps)
    assert different.count() == 0


def test_stop_words_are_sparks_default(spark):
    assert list(SPARK_ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")
    assert STOP_WORDS[-1] == "rt"


def test_remove_equals_ml_remover(texts):
    words = texts.select("id", X.plain_words(F.col("text")).alias("w"))
    remover = StopWordsRemover(inputCol="w", outputCol="o", stopWords=list(STOP_WORDS))
    expected = values(remover.transform(words), F.col("o"))
    assert values(words, X.remove_stop_words(F.col("w"))) == expected


def test_sentence(spark):
    row = spark.createDataFrame([(0, ['a"b', "c"])], "id int, w array<string>")
    assert values(row, X.sentence(F.col("w"))) == ["ab c"]
