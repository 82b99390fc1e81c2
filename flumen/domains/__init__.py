"""End-to-end recipes of the reference's domains, as DataFrame functions."""
