"""Data operators (DataFrame -> DataFrame, or Column builders).

chunking (T1-T6), chatlog (S2 F4 F7 C1-C5), qa (S3 F5 Q1-Q4),
convo (V1-V4 V8), templates (V5-V7 V9-V12 F9), assemble (D1-D11 F6 F8),
generate (F1-F3 S5 P1-P6), similarity (M1 M2), evaluate (E1-E6),
charset (X1-X5).
"""
