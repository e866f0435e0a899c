import numpy as np
import pyarrow as pa

from tollgate.llm import lattice_lm


def test_words_of_small_batches_are_scored_together():
    batches = [pa.RecordBatch.from_arrays([pa.array([f"w{i}".encode()])], names=["word"]) for i in range(100)]
    joined = list(lattice_lm._grouped(iter(batches)))
    assert len(joined) == 1 and joined[0].column("word").to_pylist() == [f"w{i}".encode() for i in range(100)]
    assert not list(lattice_lm._grouped(iter([])))


def test_probabilities_and_logarithms_agree():
    lattice = lattice_lm.Lattice(np.arange(32_000.0)[:lattice_lm._processor(None).get_piece_size()])
    for _, codes in lattice.blocks(["the", "house", "maison", "été", "a" * 40, "𝒳漢" * 3, "x"]):
        np.testing.assert_allclose(lattice.same_length(codes), lattice._in_logs(codes), rtol=1e-12)
        np.testing.assert_allclose(lattice.expected(codes), lattice._expected_in_logs(codes), rtol=1e-9, atol=1e-12)
    # Long words of unknown letters go beyond what doubles hold as probabilities.
    long = lattice.marginals(["\U0010fff0" * 60, "the"])
    assert np.isfinite(long).all() and long[0] < np.log(1e-300) < long[1]
