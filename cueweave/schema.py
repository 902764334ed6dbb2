"""Schemas of the tables. Times are whole milliseconds from the start of the media."""

from __future__ import annotations

CUES = "file string, ep string, idx int, start_line int, srt_index int, start_ms long, end_ms long, text string, is_garbled boolean, garbled_type string"
ASS_LINES = "file string, line int, kind string, layer string, start string, end string, style string, name string, margin_l string, margin_r string, margin_v string, effect string, text string"
SPEECH = "ep string, seg_idx int, start_ms long, end_ms long"
ASR = "ep string, seg_idx int, start_ms long, end_ms long, text string, no_speech_prob double, avg_logprob double, compression_ratio double"
FIXES = "seq long, action string, file string, start_ms long, line int, original string, replacement string, pattern string, count int"
REPORT = "layer string, ep string, time string, original string, corrected string, status string"
GLOSSARY = "category string, canonical string, total_freq long, variants array<struct<word:string,freq:long>>, source string"
LYRICS = "song_id string, region string, ep_lo int, ep_hi int, time_ms long, src string, dst string"

#: statuses of a report entry, from the weakest to the strongest
STATUSES = ("⬜", "🗑️", "✅")
