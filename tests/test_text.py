import re


from lexigrove.functions import text as X
from lexigrove.functions.constants import TOKEN_STOP_WORDS
from lexigrove.operators import tokens as K


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column.alias("r")).first()["r"]


def test_clean_text_keeps_letters_and_single_spaces(spark):
    assert one(spark, "The quick brown FOXES were jumping!!!", X.clean_text("c")) == "the quick brown foxes were jumping"
    assert one(spark, "Hello   world\nthis\t is \r\n spaced", X.clean_text("c")) == "hello world this is spaced"
    assert one(spark, "x y", X.clean_text("c")) == "x y"


def test_tokenize_respects_unicode_word_boundaries(spark):
    assert one(spark, "café abc123 a_b foo-bar naïve", X.tokenize("c")) == ["foo", "bar"]
    assert one(spark, "the cat is on a mat", X.tokenize("c")) == ["cat", "mat"]


def test_tokenize_and_clean_match_python_on_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "text", X.tokenize("text").alias("tokens"), X.clean_text("text").alias("clean"), X.word_count("text").alias("words")
    ).collect()
    stops = set(TOKEN_STOP_WORDS)
    for row in rows:
        words = [w for w in re.findall(r"\b[a-z]+\b", row.text.lower()) if len(w) > 2 and w not in stops]
        assert row.tokens == words
        assert row.clean == " ".join(re.sub(r"[^a-zA-Z\s]", "", row.text.lower()).split())
        assert row.words == len(row.text.split())


def test_empty_documents_drop_out_and_ids_stay(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "  "), (3, "gamma"), (4, "on the"), (5, None)], "doc_id long, text string")
    kept = {r.doc_id: r.tokens for r in K.tokenize_documents(docs).collect()}
    assert kept == {1: ["alpha", "beta"], 3: ["gamma"]}
    counts = K.document_filter_counts(docs).first().asDict()
    assert counts == {"total": 5, "blank": 2, "without_tokens": 1, "kept": 2}


def test_sentences_and_counts(spark):
    assert one(spark, "One two.\n Three!? four", X.sentences("c")) == ["One two", "Three", "four"]
    assert one(spark, " a  b c ", X.word_count("c")) == 3
    assert one(spark, "  ab \n", X.strip("c")) == "ab"


def test_ngrams(spark):
    tokens = spark.createDataFrame([(["a", "b", "c"],), (["a", "b"],), (["z"],)], "tokens array<string>")
    assert {r.ngram: r.n for r in K.ngram_counts(tokens, 2).collect()} == {"a b": 2, "b c": 1}
    assert {r.ngram: r.n for r in K.ngram_counts(tokens, 3).collect()} == {"a b c": 1}


def test_lemmas_replace_forms_in_order(spark):
    docs = spark.createDataFrame([(1, "The cats were chasing Dogs, cats!"), (2, "on the")], "doc_id long, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "form string, lemma string")
    out = {r.doc_id: r.text for r in K.lemmatize_documents(docs, lemmas).collect()}
    assert out == {1: "cat chasing dog cat", 2: ""}


def test_word_char_counts(spark):
    docs = spark.createDataFrame([(1, "  two words ")], "doc_id long, text string")
    row = K.word_char_counts(docs).first()
    assert (row.char_count, row.word_count) == (9, 2)


def test_tokens_are_built_once(spark, sf_dir):
    """The plan evaluates the tokeniser's pattern once, not again in a pushed-down filter."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = K.tokenize_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
