"""Models behind small interfaces: loaded once per Python worker, never per row.

``detect(samples, rate)`` gives (start, end) in samples; ``diarize(samples,
rate)`` gives lines ``start end speaker`` in seconds; ``transcribe(batch)`` gives
a text per (samples, rate); ``denoise(samples, rate)``, if there is one, gives
samples, once per file; ``enhance(samples, rate, **options)`` gives samples
and a rate; ``decode(content, suffix)`` gives (channels, samples) and a rate.
Language, window and token limits are settings of a model's own, given where it
is made.  The stand-ins need no model files.
"""

from __future__ import annotations

from typing import Protocol

import numpy as np


class Vad(Protocol):
    def detect(self, samples: np.ndarray, rate: int) -> list[tuple[int, int]]: ...


class Diarizer(Protocol):
    def diarize(self, samples: np.ndarray, rate: int) -> list[str]: ...


class Asr(Protocol):
    def transcribe(self, batch: list[tuple[np.ndarray, int]]) -> list[str]: ...


class Enhancer(Protocol):
    def enhance(self, samples: np.ndarray, rate: int, **options) -> tuple[np.ndarray, int]: ...


class Decoder(Protocol):
    def decode(self, content: bytes, suffix: str) -> tuple[np.ndarray, int]: ...


class WithFallback:
    """A diarizer that hands a stretch to the second one where the first fails, as when a device runs out of memory."""

    def __init__(self, first: Diarizer, second: Diarizer):
        self.first, self.second = first, second

    def diarize(self, samples, rate):
        try:
            return self.first.diarize(samples, rate)
        except (MemoryError, RuntimeError):
            return self.second.diarize(samples, rate)


class EnergyVad:
    """Speech is where a frame of 30 ms is louder than a share of the loudest; gaps under 300 ms close."""

    def __init__(self, share: float = 0.1, frame_s: float = 0.03, gap_s: float = 0.3):
        self.share, self.frame_s, self.gap_s = share, frame_s, gap_s

    def detect(self, samples, rate):
        frame = max(1, int(self.frame_s * rate))
        n = len(samples) // frame
        if not n:
            return []
        rms = np.sqrt((np.asarray(samples[: n * frame], dtype=np.float64).reshape(n, frame) ** 2).mean(axis=1))
        out: list[tuple[int, int]] = []
        for i in np.flatnonzero((rms >= self.share * rms.max()) & (rms > 1e-6)).tolist():
            a, b = i * frame, (i + 1) * frame
            if out and a - out[-1][1] <= self.gap_s * rate:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out


class OneSpeaker:
    """Gives each stretch of speech to one speaker."""

    def __init__(self, vad: Vad | None = None):
        self.vad = vad or EnergyVad()

    def diarize(self, samples, rate):
        return [f"{a / rate:.3f} {b / rate:.3f} speaker_0" for a, b in self.vad.detect(samples, rate)]


class LengthAsr:
    """Says how long a clip is: a stand-in that tests can predict."""

    def transcribe(self, batch):
        return [f"{len(x) / r:.2f} seconds." for x, r in batch]


class NoEnhancement:
    def enhance(self, samples, rate, **options):
        return samples, rate
