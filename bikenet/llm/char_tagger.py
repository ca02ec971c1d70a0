"""A character tagger in numpy: embeddings, one LSTM in each direction and a linear chain CRF over BIO tags.

Texts come as arrays of character codes, all of one length in a batch; code 0 is padding and carries tag 0
(no span). Training follows the gradient of the CRF's log-likelihood with Adam.
"""

from __future__ import annotations

import numpy as np

EMBEDDING, HIDDEN = 12, 20
#: Codes: 0 padding, 1 to 127 ASCII, then letters beyond, white space beyond, anything else.
CODES = 131
_NEVER = -1e4


def codes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    for place in np.flatnonzero((codes > 127) | (codes == 0)):
        char = text[place]
        codes[place] = 128 if char.isalpha() else 129 if char.isspace() else 130
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)


class Tagger:
    def __init__(self, kinds: int, seed: int = 0, embedding: int = EMBEDDING, hidden: int = HIDDEN, dtype=np.float32):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = 2 * kinds + 1, hidden

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(dtype)

        self.weights = {"chars": rng.standard_normal((CODES, embedding)).astype(dtype) * dtype(0.3)}
        for side in "fb":
            self.weights[f"x{side}"] = normal(embedding, 4 * hidden)
            self.weights[f"h{side}"] = normal(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, dtype=dtype)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights[f"c{side}"] = bias
        self.weights |= {"out": normal(2 * hidden, self.tags), "bias": np.zeros(self.tags, dtype=dtype),
                         "moves": np.zeros((self.tags, self.tags), dtype=dtype)}
        # tag 2k+1 begins kind k, tag 2k+2 goes on with it
        self.allowed = np.ones((self.tags, self.tags), dtype=bool)
        for inside in range(2, self.tags, 2):
            self.allowed[:, inside] = False
            self.allowed[[inside - 1, inside], inside] = True
        self.first = np.zeros(self.tags, dtype=dtype)
        self.first[2::2] = _NEVER

    def moves(self) -> np.ndarray:
        return np.where(self.allowed, self.weights["moves"], self.weights["moves"].dtype.type(_NEVER))

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        w, size = self.weights, self.hidden
        projected = x @ w[f"x{side}"] + w[f"c{side}"]
        h = c = np.zeros((x.shape[1], size), dtype=x.dtype)
        out, kept = np.empty((*x.shape[:2], size), dtype=x.dtype), []
        for t in range(len(x)):
            z = projected[t] + h @ w[f"h{side}"]
            gates, new = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
            before, c = c, gates[:, size : 2 * size] * c + gates[:, :size] * new
            squashed = np.tanh(c)
            kept.append((h, before, gates, new, squashed))
            h = out[t] = gates[:, 2 * size :] * squashed
        return out, kept

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Score of each tag at each place; ``codes`` and the result are led by time, then by text."""
        x = self.weights["chars"][codes]
        ahead, _ = self._lstm(x, "f")
        back, _ = self._lstm(x[::-1], "b")
        return np.concatenate([ahead, back[::-1]], axis=2) @ self.weights["out"] + self.weights["bias"]

    def loss_and_gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood of the tags per text, and its gradient by weight."""
        w, size = self.weights, self.hidden
        x = w["chars"][codes]
        ahead, kept_f = self._lstm(x, "f")
        back, kept_b = self._lstm(x[::-1], "b")
        both = np.concatenate([ahead, back[::-1]], axis=2)
        scores = both @ w["out"] + w["bias"]
        steps, texts = codes.shape
        moves = self.moves()

        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = self.first + scores[0]
        for t in range(1, steps):
            alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + moves, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        place, text = np.ogrid[:steps, :texts]
        own = scores[place, text, tags].sum(axis=0) + moves[tags[:-1], tags[1:]].sum(axis=0) + self.first[tags[0]]
        loss = float((total - own).mean())

        d_scores = np.exp(alpha + beta - total[:, None])
        d_scores[place, text, tags] -= 1
        d_moves = np.zeros_like(moves)
        for t in range(1, steps):
            d_moves += np.exp(alpha[t - 1][:, :, None] + moves + (scores[t] + beta[t] - total[:, None])[:, None, :]).sum(axis=0)
        np.subtract.at(d_moves, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        d_moves[~self.allowed] = 0
        d_scores /= texts
        flat = d_scores.reshape(-1, self.tags)
        gradients = {"moves": d_moves / texts, "out": both.reshape(-1, 2 * size).T @ flat, "bias": flat.sum(axis=0)}
        d_both = d_scores @ w["out"].T
        d_x = np.zeros_like(x)
        for side, kept, d_out, flip in (("f", kept_f, d_both[:, :, :size], False), ("b", kept_b, d_both[::-1, :, size:], True)):
            dz = np.empty((steps, texts, 4 * size), dtype=x.dtype)
            dh = dc = np.zeros((texts, size), dtype=x.dtype)
            for t in range(steps - 1, -1, -1):
                _, before, gates, new, squashed = kept[t]
                i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
                dh = dh + d_out[t]
                dc = dc + dh * o * (1 - squashed ** 2)
                dz[t, :, :size] = dc * new * i * (1 - i)
                dz[t, :, size : 2 * size] = dc * before * f * (1 - f)
                dz[t, :, 2 * size : 3 * size] = dh * squashed * o * (1 - o)
                dz[t, :, 3 * size :] = dc * i * (1 - new ** 2)
                dh, dc = dz[t] @ w[f"h{side}"].T, dc * f
            flat = dz.reshape(-1, 4 * size)
            seen = x[::-1] if flip else x
            gradients[f"x{side}"] = seen.reshape(-1, x.shape[2]).T @ flat
            gradients[f"h{side}"] = np.stack([k[0] for k in kept]).reshape(-1, size).T @ flat
            gradients[f"c{side}"] = flat.sum(axis=0)
            back_x = dz @ w[f"x{side}"].T
            d_x += back_x[::-1] if flip else back_x
        gradients["chars"] = np.zeros_like(w["chars"])
        np.add.at(gradients["chars"], codes.ravel(), d_x.reshape(-1, x.shape[2]))
        return loss, gradients

    def train(self, codes: np.ndarray, tags: np.ndarray, steps: int, batch: int, rate: float, seed: int = 0) -> list[float]:
        """Adam over batches of shuffled rounds; ``codes`` and ``tags`` are led by text. The loss of each step comes back."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses, order = [], np.zeros(0, dtype=np.int64)
        for step in range(1, steps + 1):
            while len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(codes))])
            chosen, order = order[:batch], order[batch:]
            loss, gradients = self.loss_and_gradients(codes[chosen].T, tags[chosen].T)
            losses.append(loss)
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in gradients.values()))
            now = rate * (1 - 0.8 * step / steps)
            for name, gradient in gradients.items():
                gradient = gradient * min(1.0, 5.0 / (norm + 1e-9))
                mean[name] = 0.9 * mean[name] + 0.1 * gradient
                square[name] = 0.99 * square[name] + 0.01 * gradient ** 2
                move = mean[name] / (1 - 0.9 ** step) / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-8)
                self.weights[name] = (self.weights[name] - now * move).astype(self.weights[name].dtype)
        return losses

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The likeliest tags by Viterbi; scores and tags are led by time."""
        moves = self.moves()
        best, came = self.first + scores[0], np.empty(scores.shape, dtype=np.int8)
        for t in range(1, len(scores)):
            ways = best[:, :, None] + moves
            came[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        tags = np.empty(scores.shape[:2], dtype=np.int8)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(scores.shape[1])
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t][rows, tags[t]]
        return tags
