"""Program names, slugs and the part-name grammar, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

#: The General MIDI level 1 program names, a public standard, in program order.
PROGRAMS = (
    "Acoustic Grand Piano, Bright Acoustic Piano, Electric Grand Piano, Honky-tonk Piano, Electric Piano 1, Electric Piano 2, Harpsichord, Clavi, "
    "Celesta, Glockenspiel, Music Box, Vibraphone, Marimba, Xylophone, Tubular Bells, Dulcimer, "
    "Drawbar Organ, Percussive Organ, Rock Organ, Church Organ, Reed Organ, Accordion, Harmonica, Tango Accordion, "
    "Acoustic Guitar (nylon), Acoustic Guitar (steel), Electric Guitar (jazz), Electric Guitar (clean), Electric Guitar (muted), Overdriven Guitar, Distortion Guitar, Guitar Harmonics, "
    "Acoustic Bass, Electric Bass (finger), Electric Bass (pick), Fretless Bass, Slap Bass 1, Slap Bass 2, Synth Bass 1, Synth Bass 2, "
    "Violin, Viola, Cello, Contrabass, Tremolo Strings, Pizzicato Strings, Orchestral Harp, Timpani, "
    "String Ensemble 1, String Ensemble 2, Synth Strings 1, Synth Strings 2, Choir Aahs, Voice Oohs, Synth Voice, Orchestra Hit, "
    "Trumpet, Trombone, Tuba, Muted Trumpet, French Horn, Brass Section, Synth Brass 1, Synth Brass 2, "
    "Soprano Sax, Alto Sax, Tenor Sax, Baritone Sax, Oboe, English Horn, Bassoon, Clarinet, "
    "Piccolo, Flute, Recorder, Pan Flute, Blown Bottle, Shakuhachi, Whistle, Ocarina, "
    "Lead 1 (square), Lead 2 (sawtooth), Lead 3 (calliope), Lead 4 (chiff), Lead 5 (charang), Lead 6 (voice), Lead 7 (fifths), Lead 8 (bass + lead), "
    "Pad 1 (new age), Pad 2 (warm), Pad 3 (polysynth), Pad 4 (choir), Pad 5 (bowed), Pad 6 (metallic), Pad 7 (halo), Pad 8 (sweep), "
    "FX 1 (rain), FX 2 (soundtrack), FX 3 (crystal), FX 4 (atmosphere), FX 5 (brightness), FX 6 (goblins), FX 7 (echoes), FX 8 (sci-fi), "
    "Sitar, Banjo, Shamisen, Koto, Kalimba, Bag pipe, Fiddle, Shanai, "
    "Tinkle Bell, Agogo, Steel Drums, Woodblock, Taiko Drum, Melodic Tom, Synth Drum, Reverse Cymbal, "
    "Guitar Fret Noise, Breath Noise, Seashore, Bird Tweet, Telephone Ring, Helicopter, Applause, Gunshot"
).split(", ")
#: Guitars are the programs 24 to 31; percussion has one name.
GUITARS, DRUMS = (24, 31), "drums"


def slug_text(text: str) -> str:
    """The slug of a plain string."""
    return re.sub("[^a-z0-9]+", "-", text.lower().replace("+", " plus ")).strip("-")


SLUGS = [slug_text(p) for p in PROGRAMS]


def slug(text: Column) -> Column:
    """Lower case, ``+`` as ``plus``, all runs of other characters one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.replace(F.lower(text), F.lit("+"), F.lit(" plus ")), "[^a-z0-9]+", "-"), F.lit("-"))


def program_of(slug_column: Column) -> Column:
    """Program number of a slug, null if there is none (a lookup in a constant table of 128)."""
    found = F.array_position(F.array(*map(F.lit, SLUGS)), slug_column)
    return F.when(found > 0, (found - 1).cast("int"))


def program_name(program: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, PROGRAMS)), program + 1)


def is_guitar(program: Column) -> Column:
    return F.coalesce(program.between(*GUITARS), F.lit(False))


def part_name(program: Column, is_drum: Column, rhythm: Column) -> Column:
    """Canonical name of a part; only ``rhythm`` is annotated."""
    base = F.when(is_drum, DRUMS).otherwise(F.try_element_at(F.array(*map(F.lit, SLUGS)), program + 1))
    return F.concat(base, F.when(rhythm, ":rhythm").otherwise(""))


def parsed_name(name: Column, strict: bool = False) -> Column:
    """struct<program, is_drum, rhythm> of a part name, null if it is none.

    What follows ``|`` is for readers only. The annotation's first word must be rhythm, which
    only guitars take; rhythm is true or null. Strict: the name must be the canonical one to the letter.
    """
    head = F.trim(F.substring_index(name, "|", 1))
    marked = F.contains(head, F.lit(":"))
    base = F.rtrim(F.substring_index(head, ":", 1))
    note = F.regexp_extract(F.regexp_replace(head, "^[^:]*:?", ""), r"^\s*(\S*)", 1)
    rhythm = F.when(marked, True)
    fine = ~marked | (note == "rhythm")
    program = program_of(base)
    drums = base == DRUMS
    ok = fine & ((drums & ~marked) | (~drums & program.isNotNull() & (~marked | is_guitar(program))))
    parsed = F.when(ok, F.struct(F.when(~drums, program).alias("program"), drums.alias("is_drum"), rhythm.alias("rhythm")))
    if strict:
        return F.when(part_name(parsed["program"], parsed["is_drum"], parsed["rhythm"]) == name, parsed)
    return parsed
