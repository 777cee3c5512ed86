import public_tokenizers
import pyarrow as pa

from claimspark.llm import bpe
from claimspark.llm.common import ROW_BYTES, begin, parts


def test_a_batch_is_taken_in_parts_of_its_bytes():
    rows = pa.record_batch([pa.array(range(1000)), pa.array(["x" * 10_000] * 999 + [None])], ["doc_id", "text"])
    cut = list(parts(rows, ROW_BYTES))
    assert len(cut) > 1 and all(p.nbytes <= 1.01 * ROW_BYTES for p in cut)
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([rows]))
    assert [p.num_rows for p in parts(rows, None)] == [1000] and list(parts(rows.slice(0, 0), None)) == list(parts(rows.slice(0, 0), ROW_BYTES)) == []
    assert [p.num_rows for p in parts(rows.slice(0, 2), 1)] == [1, 1]


def test_a_worker_drops_the_vocabulary_when_it_goes_on_to_another_operator():
    raw = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    begin("claimspark.llm.bpe")
    made = bpe.load(raw)
    begin("claimspark.llm.bpe")
    assert bpe.load(raw) is made
    begin("claimspark.llm.language_id")
    assert bpe.load.cache_info().currsize == 0 and bpe.load(raw) is not made
    begin("claimspark.llm.bpe")
