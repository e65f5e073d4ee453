"""Inputs: vector dataset readers and writers, repeatable generators, dense
row numbers and fixed-size batches."""
