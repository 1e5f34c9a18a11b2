"""Explicit schemas; nothing is inferred, so maps stay maps and optional fields stay null."""

from __future__ import annotations

DRAFT = """
src STRING, regions STRING, rules ARRAY<STRUCT<x:INT,y:INT,w:INT,h:INT,dir:STRING>>, crossed ARRAY<ARRAY<INT>>,
blocks ARRAY<STRUCT<column:INT,region:INT,layer:STRING,text:STRING,words:ARRAY<STRUCT<t:STRING,conf:DOUBLE,x:INT,y:INT,w:INT,h:INT>>>>,
proofed BOOLEAN, note STRING"""

CORRECTIONS = """
sheet STRING, who STRING, pages MAP<STRING,STRUCT<full:BOOLEAN,note:STRING,checked:INT,lean:DOUBLE,cols:ARRAY<DOUBLE>,
fix:MAP<STRING,STRUCT<was:STRING,now:STRING,after:STRING>>,str:MAP<STRING,STRUCT<do:STRING,was:STRING>>>>"""

TABLE_FIX = "ops MAP<STRING,STRUCT<do:STRING,was:STRING>>, cols ARRAY<DOUBLE>, lean DOUBLE"

TSV = "level INT, page INT, block INT, par INT, line INT, word INT, left INT, top INT, width INT, height INT, conf STRING, text STRING"

SNAPSHOT = "src STRING, words STRING, shape STRING, n INT, markup STRING"
