"""Writers: bucketed archive, CSV reports, JSON documents."""
