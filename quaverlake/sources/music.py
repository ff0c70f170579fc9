"""Notation and MIDI bytes as event rows."""

from __future__ import annotations

import io
import math
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame

MIDI_SCHEMA = (
    "id string, track int, ordinal int, tick long, kind string, channel int, pitch int, velocity int, program int,"
    " port int, controller int, value int, name string, issue string"
)
NOTE_SCHEMA = "id string, part_id string, measure int, onset_num long, onset_den long, duration_num long, duration_den long, pitch int, staff int, voice string, grace boolean, issue string"

#: Semitones of the steps above C.
STEPS = {"C": 0, "D": 2, "E": 4, "F": 5, "G": 7, "A": 9, "B": 11}


def _number(body: bytes, at: int) -> tuple[int, int]:
    """A variable-length quantity and the position after it."""
    value = 0
    for _ in range(4):
        byte = body[at]
        at += 1
        value = value << 7 | byte & 127
        if byte < 128:
            return value, at
    raise ValueError("quantity of over four bytes")


def midi_events(body: bytes) -> Iterator[tuple]:
    """(track, ordinal, tick, kind, channel, pitch, velocity, program, port, controller, value, name) of a standard MIDI file.

    kind: on, off, program, control or name. Meta and system events end a running status;
    a data byte without a status, or an event beyond its track's end, is an error.
    """
    if body[:4] != b"MThd" or len(body) < 14:
        raise ValueError("not a MIDI file")
    length, _, tracks = struct.unpack(">IHH", body[4:12])
    at = 8 + length
    for track in range(tracks):
        if body[at : at + 4] != b"MTrk":
            raise ValueError("track header expected")
        end = at + 8 + struct.unpack(">I", body[at + 4 : at + 8])[0]
        if end > len(body):
            raise ValueError("track beyond the file's end")
        at, tick, ordinal, status, port = at + 8, 0, 0, 0, 0
        while at < end:
            delta, at = _number(body, at)
            tick += delta
            if body[at] & 128:
                status = body[at]
                at += 1
            elif not status:
                raise ValueError("data byte without a status")
            none = (None,) * 7
            if status >= 0xF0:
                meta = body[at] if status == 0xFF else None
                size, at = _number(body, at + (status == 0xFF))
                text, at, status = body[at : at + size], at + size, 0
                if meta == 0x21 and size == 1:
                    port = text[0]
                elif meta in (3, 4):
                    yield track, ordinal, tick, "name", None, None, None, None, port, None, None, text.decode("utf-8", "replace")
                    ordinal += 1
                continue
            kind, channel, a = status >> 4, status & 15, body[at]
            two = kind not in (12, 13)
            b = body[at + 1] if two else None
            at += 1 + two
            if at > end:
                raise ValueError("event beyond its track's end")
            if kind in (8, 9):
                yield track, ordinal, tick, "on" if kind == 9 and b else "off", channel, a, b, None, port, *none[:3]
            elif kind == 12:
                yield track, ordinal, tick, "program", channel, None, None, a, port, *none[:3]
            elif kind == 11:
                yield track, ordinal, tick, "control", channel, None, None, None, port, a, b, None
            ordinal += 1


def musicxml(body: bytes) -> bytes:
    """The score of a compressed file, or the body itself."""
    if body[:2] != b"PK":
        return body
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        root = ET.fromstring(z.read("META-INF/container.xml"))
        path = next(e.get("full-path") for e in root.iter() if e.tag.endswith("rootfile"))
        return z.read(path)


def _shift(transpose) -> Fraction:
    """Semitones of a transposition, octaves and quarter tones included."""
    tones = Fraction(transpose.findtext("chromatic") or 0) + 12 * int(transpose.findtext("octave-change") or 0)
    return tones + (12 if transpose.find("double") is not None else 0)


def notes(body: bytes) -> Iterator[tuple]:
    """(part, measure, onset, duration, pitch, staff, voice, grace) with onsets and durations in quarters.

    A transposition holds for its staff, or for all staves; a pitch between semitones is
    rounded to the nearest one, halves up.
    """
    for part in ET.fromstring(musicxml(body)).iter("part"):
        divisions, begin, shifts = 1, Fraction(0), {}
        for number, measure in enumerate(part.iter("measure")):
            cursor = last = far = Fraction(0)
            for e in measure:
                if e.tag == "attributes":
                    divisions = int(e.findtext("divisions") or divisions)
                    for t in e.iter("transpose"):
                        if t.get("number") is None:
                            shifts = {}
                        shifts[t.get("number")] = _shift(t)
                step = Fraction(int(e.findtext("duration") or 0), divisions)
                if e.tag == "backup":
                    cursor -= step
                elif e.tag == "forward":
                    cursor += step
                elif e.tag == "note":
                    grace, chord, staff = e.find("grace") is not None, e.find("chord") is not None, e.findtext("staff") or "1"
                    onset, pitch, sound = last if chord else cursor, e.find("pitch"), None
                    if pitch is not None:
                        tones = STEPS[pitch.findtext("step")] + Fraction(pitch.findtext("alter") or 0) + shifts.get(staff, shifts.get(None, 0))
                        sound = math.floor(tones + Fraction(1, 2)) + 12 * (int(pitch.findtext("octave")) + 1)
                    yield part.get("id"), number, begin + onset, step, sound, int(staff), e.findtext("voice") or "1", grace
                    if not chord:
                        last = cursor
                        cursor += step
                far = max(far, cursor)
            begin += far


def marks(body: bytes) -> Iterator[tuple]:
    """(part, measure, kind, text, staff): the parts' names, clefs and harmonies of a score, in order."""
    root = ET.fromstring(musicxml(body))
    for part in root.iter("score-part"):
        yield part.get("id"), None, "part", part.findtext("part-name") or "", None
    for part in root.iter("part"):
        for number, measure in enumerate(part.iter("measure")):
            for clef in measure.iter("clef"):
                text = (clef.findtext("sign") or "") + (clef.findtext("line") or "") + ("8" * abs(int(clef.findtext("clef-octave-change") or 0)))
                yield part.get("id"), number, "clef", text, int(clef.get("number") or 1)
            for harmony in measure.iter("harmony"):
                root_step = harmony.findtext("root/root-step") or ""
                yield part.get("id"), number, "harmony", f"{root_step} {harmony.findtext('kind') or ''}".strip(), int(harmony.findtext("staff") or 1)


def _rows(files: DataFrame, events, schema: str) -> DataFrame:
    """Rows of files (id, body) by ``events``; a file that can't be read gives one row with its issue and nothing else."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def rows_of(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows: list[tuple] = []
            for i, body in zip(pdf.id, pdf.body):
                try:
                    rows += [(i, *e, None) for e in events(bytes(body))]
                except (ValueError, KeyError, IndexError, TypeError, struct.error, ET.ParseError, zipfile.BadZipFile, StopIteration) as e:
                    rows.append((i, *(None,) * (len(names) - 2), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return files.select("id", "body").mapInPandas(rows_of, schema)


def read_midi(files: DataFrame) -> DataFrame:
    """Events of files (id, body); a file that can't be read gives one row with its issue."""
    return _rows(files, lambda body: list(midi_events(body)), MIDI_SCHEMA)


def _note_rows(body: bytes) -> list[tuple]:
    return [(part, m, on.numerator, on.denominator, dur.numerator, dur.denominator, *rest) for part, m, on, dur, *rest in notes(body)]


def read_notes(files: DataFrame) -> DataFrame:
    """Notes of files (id, body); a file that can't be read gives one row with its issue."""
    return _rows(files, _note_rows, NOTE_SCHEMA)


def read_marks(files: DataFrame) -> DataFrame:
    """Part names, clefs and harmonies of files (id, body); a file that can't be read gives one row with its issue."""
    return _rows(files, lambda body: list(marks(body)), "id string, part_id string, measure int, kind string, text string, staff int, issue string")
