from joinery.llm.features import _Shapes


def test_shape_of_a_whole_token():
    shapes = _Shapes()
    assert shapes[b"a0" * 32 + b"A"] != shapes[b"a0" * 32 + b"|"]
    assert shapes[b"a" * 100] == shapes[b"a"] and shapes[b"a" * 100 + b"0"] == shapes[b"a0"]
