import pyarrow as pa

from hubbub import session


def test_python_sees_a_batch_in_slices(monkeypatch):
    """However many rows a batch has, one call gets about as many bytes as a slice may have."""
    monkeypatch.setattr(session, "SLICE_BYTES", 1000)
    for column in (pa.array([f"{i:0100}" for i in range(500)] + [None, ""]), pa.array([[f"{i:050}", "x"] for i in range(500)])):
        seen = []

        def run(part):
            seen.append(part.nbytes)
            return pa.array([str(v) for v in part.to_pylist()])

        assert session.in_slices(column, run).to_pylist() == [str(v) for v in column.to_pylist()]
        assert max(seen) <= 1100 and len(seen) > 20
    assert session.in_slices(pa.array([], pa.string()), lambda part: part).to_pylist() == []
