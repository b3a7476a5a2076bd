import io

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from tokenizers.models import WordLevel

from perilgrid.llm.token_frames import FrameReader, FrameWriter, id_width


def test_ids_beyond_the_width_are_an_error():
    with pytest.raises(ValueError):
        FrameWriter(io.BytesIO(), 2).add(1, np.array([5, 1 << 16], "<u4").tobytes())
    stream = io.BytesIO()
    writer = FrameWriter(stream, 4)
    writer.add(1, np.array([5, 1 << 16], "<u4").tobytes())
    writer.close()
    assert FrameReader(stream, len(stream.getvalue())).document(0).tolist() == [5, 1 << 16]


def test_width_follows_the_vocabulary(tmp_path):
    path = str(tmp_path / "large.json")
    Tokenizer(WordLevel({"a": 0, "b": 1 << 16}, unk_token="a")).save(path)
    assert id_width(path) == 4
    assert id_width(public_tokenizers.path("byte_bpe_50k.json")) == 2
    assert id_width(public_tokenizers.path("byte_bpe_50k.json"), 1 << 16) == 4
