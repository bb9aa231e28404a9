"""Explicit schemas, as DDL, of all tables that the engine reads and writes; they need no session to be imported."""

from __future__ import annotations

CORPUS = "row_id bigint, title string, body string, category string"
DEFINITION = "category string, definition string"
RULE = "category string, pos int, rule string"
STYLE = "pos int, name string, description string, tone string, title_min int, title_max int, body_min int, body_max int"
STYLE_LIMIT = "pos int, style string, share_limit double"
ALLOWED_STYLE = "category string, pos int, style string"
ALLOCATION = "category string, style string, style_pos int, needed int"
REQUEST = "category string, style string, style_pos int, round int, batch_idx int, messages array<struct<role:string,content:string>>, seed_ids array<string>, shown_seed_ids array<string>"
ANSWER = "category string, style string, round int, batch_idx int, content string, error string"
SAMPLE = "title string, body string, model_category string, model_style string, extras map<string,string>, malformed boolean"
#: The same as the type of a column.
SAMPLE_TYPE = "struct<title:string,body:string,model_category:string,model_style:string,extras:map<string,string>,malformed:boolean>"
CANDIDATE = "category string, style string, round int, batch_idx int, sample_idx int, title string, body string, model_category string, model_style string, extras map<string,string>, malformed boolean"
OUTPUT = "title string, body string, category string, style string, is_synth boolean, seed_ids array<string>, prompt_style string, gen_model string, created_at timestamp, uuid string"
