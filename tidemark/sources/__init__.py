"""File scans, slice publishing, quarantine, intake and the keyed event log."""
