import numpy as np

from countflow.llm.gru import Gru


def test_every_symbol_is_trained_on_once(monkeypatch):
    rng = np.random.default_rng(2)
    documents = [np.append(rng.integers(1, 70, n), 0) for n in rng.integers(1, 400, 60).tolist()]
    seen, begun = [], 0
    real = Gru.train_window

    def keep(self, x, y, fresh, h, rate):
        nonlocal begun
        seen.extend(y.ravel().tolist())
        begun += int(fresh.sum())
        return real(self, x, y, fresh, h, rate)

    monkeypatch.setattr(Gru, "train_window", keep)
    Gru(np.full(64, 1.0), np.full(6, 1.0)).train(documents)
    assert sorted(seen) == sorted(np.concatenate(documents).tolist()) and begun == len(documents)
    assert len(seen) % (len(seen) // 64)  # some streams are longer
