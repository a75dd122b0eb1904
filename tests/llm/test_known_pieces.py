"""New pieces of letters reach the model as words; tasks are sent without a tokenizer."""

import pyarrow as pa
from public_tokenizers import path as public_path
from pyspark.serializers import CloudPickleSerializer

from barlake.llm import token_store

PATH = public_path("byte_bpe_50k.json")


class Counted:
    """A tokenizer that notes what it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.given.extend(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


def test_letters_are_split_by_the_model_alone():
    enc = token_store.PieceEncoder(PATH)
    plain = enc.tokenizer
    codes = [*range(0x41, 0x530), *range(0x3041, 0x3100), *range(0x4E00, 0x9FA6, 7), *range(0xAC00, 0xD7A4, 7)]
    letters = [chr(c) for c in codes if chr(c).isalpha()]
    text = "a " + " ".join(f"x{c}{c}Yz \n{c}e {c}" for c in letters).replace(" \n", "\n")
    enc.tokenizer = Counted(plain)
    ids, sizes = enc.encode(pa.array([text]))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids)]
    assert sum(map(len, enc.tokenizer.given)) < len(text) / 4  # most came to the model as words


def test_the_driver_sends_no_tokenizer(spark, tmp_path):
    token_store._encoders.clear()
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    token_store.write_token_store(df, str(tmp_path), PATH)
    assert token_store._encoders == {}
    assert len(CloudPickleSerializer().dumps(token_store.tokenised(PATH, 0))) < 100_000
