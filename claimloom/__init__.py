"""claimloom: batch entity resolution, claim verification and text-corpus operators on PySpark."""
