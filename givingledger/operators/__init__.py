"""DataFrame-to-DataFrame building blocks of the donor export."""
