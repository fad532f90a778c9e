"""Tender-record and bidder-risk analytics on Spark DataFrames."""
