"""Pieces of any length stand in the lattice."""

import numpy as np

from larder.llm import lattice


def test_long_pieces_count():
    long = " правительство".encode()
    ranks = {bytes([k]): k for k in range(256)} | {long: 256, b" " * 40: 257}
    pieces = lattice.Pieces(ranks)
    assert long in pieces.tokens and b" " * 40 not in pieces.tokens
    m = np.frombuffer(long, np.uint8)[None]
    arcs = pieces.arcs(m)
    assert pieces.tokens[arcs[len(long)][0, 0]] == long and set(arcs) == {1, len(long)}
